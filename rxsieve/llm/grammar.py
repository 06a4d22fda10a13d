"""Re-Pair grammars over token ids: frequent neighbours become one symbol, again and again.

Each round counts the pairs of neighbouring symbols and gives every frequent pair a new symbol, a nonterminal.
Where two frequent pairs overlap, the more frequent one is replaced. Rounds go on until no pair is frequent. A pair never crosses the end of a text, so
each text keeps a run of symbols of its own, and a symbol's expansion length tells how many ids it stands for: a text, or a
place in it, is found without expanding what lies before.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Pairs are first counted in ``1 << SLOTS`` places, those of full places then exactly.
SLOTS = 18
#: A pair must stand this often to get a symbol.
FREQUENT = 8
MIX = np.uint64(0x9E3779B97F4A7C15)


class Grammar(NamedTuple):
    first_rule: int  # symbols from here on are nonterminals
    rules: np.ndarray  # (n, 2): what each nonterminal stands for, earlier symbols only
    lengths: np.ndarray  # ids that each nonterminal expands to
    symbols: np.ndarray
    ends: np.ndarray  # symbols up to the end of each text


def _frequent(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the pairs that stand ``FREQUENT`` times or more, the number of each one's kind, and the kinds' counts."""
    mixed = pair * MIX
    mixed >>= np.uint64(64 - SLOTS)
    slot = mixed.astype(np.int32)
    full = np.flatnonzero((np.bincount(slot, minlength=1 << SLOTS) >= FREQUENT)[slot])
    held = pair[full]
    order = np.argsort(held)
    in_order = held[order]
    starts = np.flatnonzero(np.append(True, in_order[1:] != in_order[:-1])) if len(held) else np.zeros(0, np.int64)
    count = np.diff(np.append(starts, len(held)))
    number = np.cumsum(count >= FREQUENT, dtype=np.int32)
    number[count < FREQUENT] = 0
    kind = np.empty(len(held), np.int32)
    kind[order] = np.repeat(number, count)
    often = kind > 0
    return full[often], kind[often] - 1, count[count >= FREQUENT]


def _chosen(at: np.ndarray, following: np.ndarray, kind: np.ndarray, count: np.ndarray, turn: int) -> np.ndarray:
    """Which of the pairs at the places ``at`` are replaced: of two that overlap the more frequent one, of equally frequent ones by a draw for each kind.

    A draw, and not the place, decides, so that in a repeated passage pairs all along it are replaced at once. In a run of one pair every other one is.
    """
    draw = np.arange(turn + 1, turn + 1 + len(count), dtype=np.uint64) * MIX
    order = np.lexsort((draw, count))
    rank = np.empty(len(count), np.int32)
    rank[order] = np.arange(1, len(count) + 1)
    key = rank[kind]
    before, after = np.zeros_like(key), np.zeros_like(key)
    beside = at[1:] == following[:-1]
    np.multiply(key[:-1], beside, out=before[1:])
    np.multiply(key[1:], beside, out=after[:-1])
    chosen = (before <= key) & (after <= key)
    runs = np.flatnonzero(before == key)
    if len(runs):
        # pairs whose neighbour is of the same kind: every other one, the first only if nothing before it is replaced
        starts = np.flatnonzero(before != key)
        group = np.searchsorted(starts, runs, "right") - 1
        place = runs - starts[group] - (before > key)[starts[group]]
        chosen[runs] = (place % 2 == 0) & (after[runs] <= key[runs])
    return chosen


def compress(ids: np.ndarray, ends: np.ndarray) -> Grammar:
    """``ends``: ids up to the end of each text.

    Rounds go on until no pair of neighbours stands ``FREQUENT`` times. A pair that was not frequent can become so only through a new symbol, so each
    round looks at the pairs that were frequent before it and those that have a new symbol. What is replaced stays in its place, and each symbol knows its neighbours, so that
    a round costs no more than the pairs it looks at.
    """
    n = len(ids)
    symbols = ids.astype(np.uint32)
    last = np.zeros(n, bool)
    last[ends[np.diff(ends, prepend=0) > 0] - 1] = True
    following, before = np.arange(1, n + 1), np.arange(-1, n)
    gone = np.zeros(n, bool)
    first_rule = int(ids.max()) + 1 if n else 1
    rules, lengths = [np.zeros((0, 2), np.uint32)], np.zeros(0, np.uint32)
    places = np.flatnonzero(~last)
    turn = 0
    while True:
        pair = symbols[places].astype(np.uint64)
        pair <<= np.uint64(32)
        pair |= symbols[following[places]]
        found, kind, count = _frequent(pair)
        if not len(found):
            break
        places = places[found]
        after = following[places]
        taken = _chosen(places, after, kind, count, turn)
        used = np.bincount(kind[taken], minlength=len(count))
        worth = used >= FREQUENT // 2
        symbol = np.zeros(len(count), np.uint32)
        symbol[worth] = np.arange(np.count_nonzero(worth), dtype=np.uint32) + np.uint32(first_rule + len(lengths))
        taken = np.flatnonzero(taken & worth[kind])
        at, removed, kinds = places[taken], after[taken], kind[taken]
        example = np.zeros(len(count), np.int64)
        example[kinds] = taken
        example = example[worth]
        made = np.stack([symbols[places[example]], symbols[after[example]]], 1)
        lengths = np.append(lengths, _lengths(made.ravel(), first_rule, lengths).reshape(-1, 2).sum(1).astype(np.uint32))
        rules.append(made)
        symbols[at] = symbol[kinds]
        last[at[last[removed]]] = True
        gone[removed] = True
        behind = following[removed]
        following[at] = behind
        before[behind] = at
        # all that were frequent, and those with a new symbol
        if len(places) > n >> 4:
            marked = np.zeros(n, bool)
            marked[places] = True
            # those before a pair at the start of the block are none
            marked[before[at][int(len(at) > 0 and at[0] == 0) :]] = True
            marked[removed] = False
            marked &= ~last
            places = np.flatnonzero(marked)
        else:
            places = np.unique(np.concatenate([places, before[at]]))
            places = places[int(places[0] < 0) :]
            places = places[~gone[places] & ~last[places]]
        turn += 1
    text_ends = np.zeros(len(ends), np.int64)
    some = np.diff(ends, prepend=0) > 0
    symbols, last = symbols[~gone], last[~gone]
    text_ends[some] = np.flatnonzero(last) + 1
    return Grammar(first_rule, np.concatenate(rules), lengths, symbols, np.maximum.accumulate(text_ends) if len(ends) else text_ends)


def _lengths(symbols: np.ndarray, first_rule: int, lengths: np.ndarray) -> np.ndarray:
    out = np.ones(len(symbols), np.int64)
    rule = symbols >= first_rule
    out[rule] = lengths[symbols[rule].astype(np.int64) - first_rule]
    return out


def expansions(first_rule: int, rules: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What every symbol stands for, in a row; where each begins there, and its length."""
    flat, rule = rules.ravel(), None
    while (rule := flat >= first_rule).any():
        count = rule + 1
        at = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.uint32)
        out[at[~rule]] = flat[~rule]
        pairs = rules[flat[rule].astype(np.int64) - first_rule]
        out[at[rule]], out[at[rule] + 1] = pairs[:, 0], pairs[:, 1]
        flat = out
    sizes = np.concatenate([np.ones(first_rule, np.int32), lengths.astype(np.int32)])
    return np.concatenate([np.arange(first_rule, dtype=np.uint32), flat]), np.cumsum(sizes, dtype=np.int32) - sizes, sizes


def expand(symbols: np.ndarray, first_rule: int, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids that a run of symbols stands for."""
    flat, first, sizes = expansions(first_rule, rules, lengths)
    count = sizes[symbols]
    ends = np.cumsum(count, dtype=np.int32)
    return flat[np.arange(ends[-1] if len(ends) else 0, dtype=np.int32) + np.repeat(first[symbols] - (ends - count), count)]


def text_ids(grammar: Grammar, text: int, start: int = 0, end: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``end`` of one text, expanding only the symbols that hold them."""
    own = grammar.symbols[grammar.ends[text - 1] if text else 0 : grammar.ends[text]]
    ends = np.cumsum(_lengths(own, grammar.first_rule, grammar.lengths))
    end = int(ends[-1]) if end is None and len(ends) else end or 0
    low, high = np.searchsorted(ends, start, "right"), np.searchsorted(ends, end, "left") + 1
    skipped = int(ends[low - 1]) if low else 0
    return expand(own[low:high], grammar.first_rule, grammar.rules, grammar.lengths)[start - skipped : end - skipped]
