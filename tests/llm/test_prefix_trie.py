"""The prefix trie against plain Python."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from rxsieve.llm import list_rank
from rxsieve.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
WORDS = re.compile("[^\x20\x09-\x0d]+")


def brute(rows):
    """Nodes as tuples in the order of COLUMNS."""
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x)] for c, x in turns.items()}
    rebuilt = {}
    for c, mine in own.items():
        h, first = zlib.crc32(str(c).encode()) % 4, c - int(np.fmod(c, 20))
        rebuilt[c] = tuple(own.get(first, [])[:h] + mine[h:])
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, convs in members.items():
        worth = (len(convs) - 1) * len(WORDS.findall(path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += worth
    digest = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return sorted(
        (min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p], leaves[p], saved[p], digest(p)) for p, convs in members.items()
    )


def got(spark, rows, **how):
    frame = prefix_trie(spark.createDataFrame(rows, SCHEMA), **how)
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def some(seed, n=60, lowest=0):
    draw = random.Random(seed)
    texts = ["", None, "a", "b c", "a b  c", "hello there\nyou"]
    rows = []
    for _ in range(n):
        conv = draw.randrange(lowest, lowest + 45)
        rows += [(conv, draw.choice([None, *range(6)]), draw.choice(["user", "assistant", None]), draw.choice(texts)) for _ in range(draw.randrange(1, 3))]
    # turns of one number are ordered by a hash, so only equal ones may share it here
    seen = {}
    return [r for r in rows if seen.setdefault(r[:2], (r[2] or "", r[3] or "")) == (r[2] or "", r[3] or "")]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = some(seed, 150)
    assert got(spark, rows) == brute(rows)


def test_rounds_of_the_list(spark):
    """Small runs and a small base, so that nodes are swallowed in many rounds."""
    rows = some(7, 150, -30)
    assert got(spark, rows, chunk=3, base=4) == brute(rows)


def test_many_parts_and_hot_groups(spark):
    """A conversation with half of all turns, many that begin alike, many that are alike."""
    rows = [(5, t, "user", f"w {t % 7}") for t in range(400)]
    rows += [(c, t, "user", "same" if t < 2 else f"x {c % 9}") for c in range(100, 260) for t in range(3)]
    rows += [(c, 0, "user", "only this") for c in range(1000, 1100)]
    expected = brute(rows)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert got(spark, rows, chunk=16, base=8) == expected
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_odd_rows(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "user", "x")]) == []
    # 1 takes over the first turns of 0, which is not there, and has fewer itself: a conversation without turns
    short = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 >= 2)
    rows = [(short, 0, None, None)]
    assert got(spark, rows) == brute(rows) and len(brute(rows)) == 1
    repeated = [(40, 1, "user", "a")] * 5 + [(40, None, None, "b"), (-40, 0, "user", "é" * 100_000), (-41, 0, "user", "")]
    assert got(spark, repeated) == brute(repeated)


def test_other_columns(spark):
    rows = some(3)
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", part int, words string, depth long")
    assert sorted(tuple(r) for r in prefix_trie(frame).select(*COLUMNS).collect()) == brute(rows)


def test_ranks_are_places_on_the_tour(spark):
    frame = prefix_trie(spark.createDataFrame(some(1), SCHEMA)).collect()
    assert sorted([r.entered for r in frame] + [r.left for r in frame]) == list(range(2 * len(frame)))
    assert all(r.left - r.entered == 1 for r in frame if not r.n_children)


def test_list_of_no_locality(spark):
    """A list in random order, ranked with small pieces."""
    draw = random.Random(5)
    keys = [(draw.randrange(-(1 << 62), 1 << 62), k) for k in range(500)]
    rows = [(*k, *(keys[i + 1] if i < 499 else (None, None)), 1, i % 3, i) for i, k in enumerate(keys)]
    frame = spark.createDataFrame(rows, list_rank.LIST)
    ranks = {(r.conv, r.step): tuple(r)[-3:] for r in list_rank.ranked(frame, 32, 16).collect()}
    assert ranks == {k: (i, sum(j % 3 for j in range(i)), i * (i - 1) // 2) for i, k in enumerate(keys)}
