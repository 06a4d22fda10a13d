import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rxsieve.llm import fm_index
from rxsieve.llm.decontaminate import decontaminate, find_passages, windows, without_passages
from tests.llm import brute


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), max_size=12), min_size=1, max_size=12), st.lists(st.integers(1, 5), min_size=1, max_size=4))
def test_index_finds_every_occurrence(runs, pattern):
    symbols = np.array([s for run in runs for s in (*run, 0)])
    index = fm_index.FMIndex(symbols)
    first, end = index.search(np.array([pattern]))
    places = sorted(index.locate(np.arange(first[0], end[0])).tolist())
    assert places == [k for k in range(len(symbols)) if symbols[k : k + len(pattern)].tolist() == pattern]


def test_long_equal_runs_are_ordered():
    symbols = np.array([*([1, 2] * 200), 0, *([1, 2] * 150), 0, *([2] * 90), 0])
    n, ends = len(symbols), np.cumsum(symbols == 0)
    keys = [[(0, ends[k]) if symbols[k] == 0 else (1, symbols[k]) for k in range(s, n)] for s in range(n)]
    assert fm_index.suffix_array(symbols).tolist() == sorted(range(n), key=keys.__getitem__)


def inputs(seed):
    rng = random.Random(seed)
    some = lambda n: " ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(n))
    items = [(i, some(rng.choice([0, 1, 3, 9, 10, 11, 40]))) for i in range(12)] + [(3, some(14)), (None, some(12)), (50, None)]
    texts = []
    for _ in range(60):
        text = some(rng.randrange(0, 80))
        _, item = rng.choice(items)
        cut = (item or "").split()
        texts.append(text + rng.choice([" ", ", ", "-"]) + " ".join(cut[: rng.randrange(len(cut) + 1)]).upper() + " " + some(5))
    return texts + ["", None, "!!", "ÄÖ é1 " * 30], items


@pytest.mark.parametrize(("seed", "block"), [(1, 1 << 20), (2, 200)])
def test_equals_search_at_every_place(spark, seed, block):
    texts, items = inputs(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = brute.passages(texts, items)
    for r in find_passages(docs, benchmark, block).collect():
        n, hit, found = expected[r.row.doc_id]
        spans = {w for a, b in zip(r.spans[::2], r.spans[1::2], strict=True) for w in range(a, b)}
        assert (r.n_words, spans, r["items"]) == (n, hit, sorted(found))


def test_contract_columns(spark):
    texts, items = inputs(3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = brute.passages(texts, items)
    for r in decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")).collect():
        n, hit, found = expected[r.doc_id]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert tuple(r)[1:] == (n, len(hit), len(found), digest, bool(hit))


def test_no_items_no_documents_other_columns(spark):
    docs = spark.createDataFrame([(1, "one two three", 5, "x")], "doc_id long, text string, n_words int, `row` string")
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate(docs, none).first().contaminated is False
    benchmark = spark.createDataFrame([("i", "Two three", "y")], "item_id string, text string, `row` string")
    assert decontaminate(docs, benchmark).first().n_hit == 2
    assert decontaminate(docs.limit(0), benchmark).collect() == []
    assert without_passages(docs, none).collect() == docs.collect()
    assert without_passages(docs, benchmark).collect() == []


def test_one_passage_in_many_documents_and_a_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, f"x{i} {passage} y{i}") for i in range(200)] + [(900, f"{passage} " * 3000)]
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = {r.doc_id: r.n_hit for r in decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()}
    assert got == {**dict.fromkeys(range(200), 30), 900: 90_000}


def test_items_without_an_id_hit_words(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"x {passage} y"), (2, "x y"), (3, None)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, passage), (None, passage), (None, None)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate(docs, benchmark).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got == {1: (12, 0, nothing, True), 2: (0, 0, nothing, False), 3: (0, 0, nothing, False)}
    assert [r.doc_id for r in without_passages(docs, benchmark).orderBy("doc_id").collect()] == [2, 3]


def test_repeated_items_are_one(spark):
    """A benchmark that is one row many times is as large as the row, so it takes one pass."""
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(k, f"{k} {passage}") for k in range(20)], "doc_id long, text string")
    benchmark = spark.createDataFrame([("a", passage)] * 500 + [("b", passage + " more")], "item_id string, text string")
    found = find_passages(docs, benchmark, 1000)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert {tuple(r["items"]) for r in found.collect()} == {("a", "b")}


def test_windows_of_a_large_benchmark_stay_small():
    """16 MB of words, by tracemalloc; a peak of tuples and sets was over 2 GB."""
    draw = np.random.default_rng(0)
    items, words = 3000, 900
    lists = pa.ListArray.from_arrays(pa.array(np.arange(items + 1) * words, pa.int32()), pa.array(draw.integers(-(1 << 62), 1 << 62, 40_000)[draw.integers(0, 40_000, items * words)]))
    table = pa.table({"item_id": pa.array([f"i{k // 2}" for k in range(items)]), "words": lists})
    tracemalloc.start()
    try:
        block = windows(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 300 << 20
    assert len(block.starts[10]) == items * (words - 9) and sum(x.nbytes for x in (block.vocabulary, block.words, block.starts[10], *block.owners[10])) < 64 << 20
    assert block.items(10, np.flatnonzero(block.starts[10] < 2 * words)).tolist() == [0]


def test_texts_are_found_in_whole_rows_and_beside_others(spark):
    """Whatever stands before the text, however its column is written, with one block and several; NULL texts stay NULL."""
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(None, k, t) for k, t in enumerate([f"a {passage} b", "a b c", None, "", "x " * 3000, f"{passage}"])]
    docs = spark.createDataFrame(rows, "text2 string, doc_id long, Text string")
    benchmark = spark.createDataFrame([(f"i{k}", passage if k == 0 else f"q{k} " * 12) for k in range(40)], "item_id string, text string")
    for block in (1 << 20, 200):
        found = find_passages(docs, benchmark, block)
        assert {r.row.doc_id: (r.n_words, r.spans) for r in found.collect()} == {0: (14, [1, 13]), 1: (3, []), 2: (0, []), 3: (0, []), 4: (3000, []), 5: (12, [0, 12])}
        assert {r.row.doc_id: r.row.Text for r in found.collect()} == {k: t for _, k, t in rows}
        some = find_passages(docs, benchmark, block, ["doc_id"])
        assert some.columns == ["row", "n_words", "spans", "items"] and {r.row.doc_id for r in some.where("size(spans) > 0").collect()} == {0, 5}
    assert {r.doc_id for r in without_passages(docs, benchmark).collect()} == {1, 2, 3, 4}
