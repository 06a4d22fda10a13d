"""The contracts in plain Python, over all pairs and positions."""

import collections
import hashlib
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0d]+")
ALPHANUMERIC = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def shingles(text):
    words = SPACED.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near_components(texts):
    """texts: {doc_id: text} -> {doc_id: (n_shingles, component)}."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = collections.defaultdict(list)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sorted(sets):
        shared = collections.Counter(j for s in sets[i] for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def passages(texts, items):
    """[(n_words, hit positions, item ids)] for each text."""
    windows = collections.defaultdict(set)
    for item, text in items:
        words = ALPHANUMERIC.findall((text or "").translate(LOWER))
        width = min(10, len(words))
        for k in range(len(words) - width + 1 if width else 0):
            windows[tuple(words[k : k + width])].update([] if item is None else [str(item)])
    widths = {len(x) for x in windows}
    out = []
    for text in texts:
        words = ALPHANUMERIC.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for width in widths:
            for k in range(len(words) - width + 1):
                owners = windows.get(tuple(words[k : k + width]))
                if owners is not None:
                    hit.update(range(k, k + width))
                    found |= owners
        out.append((len(words), hit, found))
    return out


def without_repeats(texts):
    """[(n_bytes, n_removed, n_spans, sha256)] for texts in their order."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        hit = [False] * len(data)
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if window in seen:
                hit[s : s + 100] = [True] * 100
            seen.add(window)
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        kept = bytes(b for b, h in zip(data, hit, strict=True) if not h)
        out.append((len(data), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


def targets(sizes):
    """{source: size} -> {source: target}, by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    left, full = float(sum(sizes.values())), {}
    while True:
        open_ = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = 3.0 * sizes[s]
            left -= full[s]
