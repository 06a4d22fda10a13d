import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rxsieve.llm.mixing import _pair, mix, mixture, n_words, repeated, targets
from tests.llm import brute

SCHEMA = "doc_id long, text string, source string"


def documents(seed, n=600, hot=0.4):
    rng = random.Random(seed)
    sources = ["b", "a", "ä", "Z", None]
    return [(i, "w " * int(rng.paretovariate(1.2) * 10), "b" if rng.random() < hot else rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 1, "d": 2, None: 5}, {"a": 0}, {"x": 3, "y": 0, None: 0}])
def test_targets_share_the_excess(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in targets(frame).collect()}
    assert got == pytest.approx(brute.targets(sizes))


@pytest.mark.parametrize("seed", [1, 2])
def test_taken_words_meet_the_targets(spark, seed):
    docs = documents(seed)
    rows = mixture(spark.createDataFrame(docs, SCHEMA)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(docs)))
    source, size = {d: s for d, _, s in docs}, {d: len(t.split()) for d, t, _ in docs}
    want = brute.targets(Counter({s: sum(size[d] for d in source if source[d] == s) for s in set(source.values())}))
    taken = Counter()
    for r in rows:
        assert r["size"] == size[r.doc_id] and r.taken == r.copies * r["size"] <= 3 * r["size"]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    for s in want:
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 30


def test_reruns_agree_whatever_the_partitions(spark):
    frame = spark.createDataFrame(documents(4, 300), SCHEMA)
    one = sorted(map(tuple, mixture(frame).collect()))
    assert one == sorted(map(tuple, mixture(frame.repartition(7)).collect()))


def test_copies_are_right_in_expectation(spark):
    docs = [(i, "w " * (1 + i % 7), "a" if i % 2 else "b") for i in range(60)]
    frame = spark.createDataFrame(docs, SCHEMA)
    total = Counter()
    for seed in range(12):
        for r in mix(frame, ["doc_id"], seed=1000 * seed).collect():
            total[r.row.doc_id] += r.copies
    sums = [sum(total[d] for d, _, s in docs if s == x) / 12 / 30 for x in "ab"]
    assert sums == pytest.approx([2 * 121 / (3 * 120), 4 * 119 / (3 * 120)], abs=0.5)


def test_words_are_runs_between_ascii_blanks(spark):
    texts = ["a b", " a\tb\nc\x0bd\x0ce\rf ", "a b", "\x1c", "", None]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(n_words("text")).collect()
    assert [r[0] for r in got] == [2, 6, 1, 1, 0, 0]


def test_odd_rows(spark):
    rows = [(None, "a b c", "x"), (None, "a b c", "x"), (1, None, "x"), (2, "", None), (3, "w " * 50_000, None), (3, "w", "y"), (3, "w", "y")]
    got = mixture(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and all(0 <= r.copies <= 3 for r in got) and all(r.copies == 0 for r in got if r["size"] == 0)
    assert mixture(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rows_stay_whole(spark):
    frame = spark.createDataFrame(documents(2, 50), SCHEMA).selectExpr("*", "doc_id as size", "doc_id as id", "source as `of`", "doc_id as part", "text as row")
    copies = {r.row.doc_id: r.copies for r in mix(frame).collect()}
    got = repeated(frame)
    assert got.columns == frame.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter({d: c for d, c in copies.items() if c})


def test_many_equal_rows_spread_over_the_tree(spark):
    """30,000 rows alike: none of the groups is large, and the targets are met."""
    frame = spark.range(30_000).selectExpr("cast(null as long) doc_id", "'a b c' text", "'x' source")
    frame = frame.unionByName(spark.range(1000).selectExpr("id doc_id", "'a b' text", "'y' source"))
    begun = time.monotonic()
    rows = mix(frame, ["source"]).groupBy("row.source").agg(F.count("*").alias("n"), F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("target").alias("target")).collect()
    assert time.monotonic() - begun < 60
    assert {r.source: r.n for r in rows} == {"x": 30_000, "y": 1000}
    assert all(abs(r.taken - r.target) <= 0.02 * r.target + 30 for r in rows)


def test_pivotal_rounding_of_a_pair(spark):
    """Words stay the same, one document becomes whole, and the draw keeps the expected copies."""
    rng = random.Random(1)
    rows = [(rng.randrange(1, 50), rng.random(), rng.randrange(1, 50), rng.random(), k) for k in range(4000)]
    frame = spark.createDataFrame(rows, "a long, p double, b long, q double, id long").select(
        "a", "p", "b", "q", F.struct(F.col("a").alias("size"), F.col("id"), F.lit(0).alias("tie"), F.col("p").alias("part")).alias("x"),
        F.struct(F.col("b").alias("size"), (F.col("id") + 10_000).alias("id"), F.lit(0).alias("tie"), F.col("q").alias("part")).alias("y"),
    )
    off = {"x": 0.0, "y": 0.0}
    for r in frame.select("a", "p", "b", "q", _pair(F.col("x"), F.col("y"), 7).alias("o")).collect():
        one, two = (r.o.done, r.o.left) if r.o.done.id < 10_000 else (r.o.left, r.o.done)
        assert abs(one.part * r.a + two.part * r.b - r.p * r.a - r.q * r.b) < 1e-6
        assert min(abs(r.o.done.part - v) for v in (0, 1)) < 1e-9 and -1e-9 <= r.o.left.part <= 1 + 1e-9
        off["x"] += one.part - r.p
        off["y"] += two.part - r.q
    assert all(abs(v) < 80 for v in off.values())
