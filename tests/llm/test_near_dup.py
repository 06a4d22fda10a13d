"""Near copies against all pairs in plain Python."""

import importlib
import random
from collections import Counter

import numpy as np
import pytest

from rxsieve.llm import near_dup
from rxsieve.llm.components import components
from rxsieve.llm.near_dup import near_duplicates, without_copies
from tests.llm.brute import near_components

SCHEMA = "doc_id long, text string"


def found(spark, rows, schema=SCHEMA, **more):
    return [tuple(r) for r in near_duplicates(spark.createDataFrame(rows, schema), **more).collect()]


def family(rng, n, words=80, edits=4):
    base = [f"w{rng.randrange(900)}" for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"x{rng.randrange(900)}"
        yield " ".join(copy)


@pytest.mark.parametrize("bucket", [near_dup.BUCKET, 6])
def test_components_of_groups_of_near_copies(spark, bucket):
    rng = random.Random(bucket)
    texts = [t for n in (1, 1, 2, 5, 60) for t in family(rng, n)] + ["a b c", "A b  c", "a b c d", "", "  ", None]
    rng.shuffle(texts)
    expected = near_components(dict(enumerate(texts)))
    got = {d: (n, c) for d, n, c, _ in found(spark, list(enumerate(texts)), bucket=bucket)}
    assert got == expected
    assert any(c != d for d, (_, c) in expected.items())


def test_pairs_that_share_every_band_of_large_buckets(spark):
    rng = random.Random(4)

    def samples(words):
        data = " ".join(words).encode()
        (shingles,) = near_dup._shingles(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        return (shingles[:, None] * near_dup._MULTIPLIERS).min(0)

    def grown(words, n):
        """More words that no sample falls on."""
        least, words = samples(words), list(words)
        for _ in range(n):
            words.append(next(x for x in (str(rng.random()) for _ in range(9999)) if (samples([*words, x]) == least).all()))
        return words

    core = [str(rng.random()) for _ in range(40)]
    ends = [grown(core, 20) for _ in range(8)]
    chains = [[end, *(grown(end, n) for n in (1, 2, 3))] for end in ends]
    texts = [" ".join(t) for t in [core, *(t for chain in chains for t in chain)]]
    expected = near_components(dict(enumerate(texts)))
    assert len({c for _, c in expected.values()}) == 9
    for bucket in (4, 12):
        assert {d: (n, c) for d, n, c, _ in found(spark, list(enumerate(texts)), bucket=bucket)} == expected


def test_exact_copies_of_a_third_of_the_rows(spark):
    rng = random.Random(3)
    texts = [" ".join(str(rng.random()) for _ in range(30)) for _ in range(40)] + ["the same text of more than five words"] * 20
    got = found(spark, list(enumerate(texts)))
    assert {d for d, *_, kept in got if kept} == set(range(41))
    assert all(c == min(d, 40) for d, _, c, _ in got)


def test_threshold_is_exact(spark):
    # three shared shingles of four link, six of ten do not
    words = [str(i) for i in range(30)]
    rows = [(1, words[:8]), (2, words[:7]), (3, words[10:22]), (4, [*words[10:20], "x", "y"])]
    assert {d: c for d, _, c, _ in found(spark, [(i, " ".join(t)) for i, t in rows])} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_nulls_and_repeated_ids(spark):
    rows = [(None, "one two three four five six"), (4, "one two three four five six"), (4, None), (4, "one two three four five six"), (None, "only here"), (None, None)]
    got = sorted(found(spark, rows), key=repr)
    assert got == sorted([(None, 2, 4, False), (4, 2, 4, True), (4, 0, 4, True), (4, 2, 4, True), (None, 1, None, True), (None, 0, None, True)], key=repr)


def test_one_row_of_each_group(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(None, "only here"), (None, "only here"), (None, base), (None, base + " x"), (3, base + " y"), (3, base + " y"), (2, base + " z")]
    rows += [(7, "a b"), (7, "a b"), (7, "c d"), (7, "e f"), (None, ""), (None, None), (8, ""), (8, ""), (9, None), (-1, "c d")]
    rows += [(None, base[::-1]), (None, base[::-1] + " v")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], SCHEMA + ", id long")
    stage = importlib.import_module("corpus_pipeline").distinct
    got = stage(spark, docs, "").collect()
    assert stage(spark, docs, "").columns == docs.columns
    kept = Counter((r.doc_id, r.text) for r in got)
    reverse = [t for d, t in kept if d is None and t and t.startswith(base[::-1])]
    assert len(reverse) == 1 and kept.pop((None, reverse[0])) == 1
    empty = [t for d, t in kept if d is None and not t]
    assert len(empty) == 1 and kept.pop((None, empty[0])) == 1
    assert kept == Counter([(None, "only here"), (2, base + " z"), (7, "a b"), (7, "e f"), (-1, "c d"), (8, ""), (9, None)])
    assert without_copies(docs.limit(0)).collect() == []


def test_empty_table_and_other_columns(spark):
    assert found(spark, []) == []
    clash = "doc_id long, text string, id long, key long, bands string, label string, shingles int"
    assert found(spark, [(7, "a b", 1, 1, "b", "l", 2)], clash) == [(7, 1, 7, True)]


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (5, 5), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}
