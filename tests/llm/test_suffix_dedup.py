import random

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from rxsieve.llm import suffix_dedup
from rxsieve.llm.suffix_dedup import remove_repeats
from rxsieve.llm.suffix_order import suffix_order
from tests.llm.brute import without_repeats

SCHEMA = "doc_id long, text string"


@settings(max_examples=400, deadline=None)
@given(st.text("abc", max_size=40))
def test_order_equals_sorting(text):
    data = text.encode()
    assert suffix_order(data) == sorted(range(len(data)), key=lambda k: data[k:])


def test_order_of_a_long_repetitive_text():
    data = b"ab" * 900 + b"a" * 700 + b"ba" * 500
    assert suffix_order(data) == sorted(range(len(data)), key=lambda k: data[k:])


def found(spark, rows, schema=SCHEMA):
    return {r.doc_id: tuple(r)[1:5] for r in remove_repeats(spark.createDataFrame(rows, schema)).collect()}


def corpus(seed):
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice("abcdefé ") for _ in range(n))
    passage, base = some(260), some(900)
    texts = []
    for _ in range(40):
        copy = list(base)
        for _ in range(rng.randrange(8)):
            copy[rng.randrange(len(copy))] = "Q"
        texts.append("".join(copy))
    texts += [some(rng.randrange(300)) + passage[rng.randrange(60) : 260 - rng.randrange(60)] + some(rng.randrange(300)) for _ in range(60)]
    texts += [base] * 25 + ["x" * 700, "xy" * 300, "x" * 99, "x" * 100, "", None, some(50) * 20]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "block"), [(1, suffix_dedup.BLOCK), (2, 5)])
def test_equals_comparing_all_windows(spark, monkeypatch, seed, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    texts = corpus(seed)
    assert found(spark, list(enumerate(texts))) == dict(enumerate(without_repeats(texts)))


def test_windows_are_settled_across_small_batches(spark):
    texts = corpus(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert found(spark, list(enumerate(texts))) == dict(enumerate(without_repeats(texts)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_spans_are_byte_positions(spark):
    text = "é" * 60
    rows = spark.createDataFrame([(2, "ab" + text + "cd"), (1, text)], SCHEMA)
    # windows of two repeated bytes: all but the first two of the first text stand earlier
    assert {r.doc_id: r.spans for r in remove_repeats(rows).collect()} == {1: [2, 120], 2: [2, 122]}


def test_odd_rows(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh") for _ in range(150))
    rows = [(None, long), (5, long), (5, long), (5, "z" + long), (6, None), (None, None)]
    got = sorted((tuple(r)[:3] for r in remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted([(None, 150, 0), (5, 150, 150), (5, 150, 150), (5, 151, 150), (6, 0, 0), (None, 0, 0)], key=repr)


@pytest.mark.parametrize("batch", [1, 10_000])
@pytest.mark.parametrize("parts", [1, 2])
def test_a_row_that_occurs_again_is_no_earlier_copy(spark, parts, batch):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh") for _ in range(150))
    rows = [(5, long), (5, long), (5, long), (None, long[::-1]), (None, long[::-1]), (7, long), (7, long)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = sorted((tuple(r)[:3] for r in remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted([(5, 150, 0)] * 3 + [(None, 150, 0)] * 2 + [(7, 150, 150)] * 2, key=repr)


def test_empty_table_and_other_columns(spark):
    assert found(spark, []) == {}
    clash = "doc_id long, text string, id long, key long, place long, windows string"
    assert found(spark, [(1, "a", 1, 1, 1, "w")], clash)[1][:3] == (1, 0, 0)


def test_rows_of_one_id_lose_nothing_that_is_not_repeated(spark):
    """Thousands of texts without an id: those of random letters keep all their bytes, the others lose what starts earlier in another row."""
    rng = random.Random(8)
    letters = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=300)) for _ in range(2000)]
    passage = "".join(rng.choices("ABCDEFGH", k=150))
    others = [str(k) * (k % 9 + 1) + "." + passage for k in range(2000)]
    frame = spark.createDataFrame([(None, t) for t in letters + others] + [(None, letters[0])] * 50, SCHEMA).repartition(7)
    got = remove_repeats(frame.withColumn("text", F.col("text"))).collect()
    clean = [r for r in got if r.n_bytes == 300]
    assert len(clean) == 2050 and {r.n_removed for r in clean} == {0}
    first = min(t.index(".") for t in others)
    kept = [r for r in got if r.n_bytes != 300 and not r.n_removed]
    assert 1 <= len(kept) <= sum(t.index(".") == first for t in others)
    assert all(r.n_removed >= 150 for r in got if r.n_bytes != 300 and r.n_removed)
