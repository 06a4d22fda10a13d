import zlib
from collections import Counter

from rxsieve.llm import sharding
from rxsieve.llm.sharding import shard_rows, shuffled, write_shards

SCHEMA = "doc_id long, text string"


def documents(spark, n=500):
    return spark.createDataFrame([(i, f"text {i % 9} " * (i % 30)) for i in range(n)], SCHEMA)


def check(rows, n, shards):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_law_of_rows(spark):
    rows = shard_rows(documents(spark)).collect()
    check(rows, 500, 24)
    text = {r.doc_id: r.text for r in documents(spark).collect()}
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r["size"] == len(text[r.doc_id].encode()) + 8 for r in rows)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_many_buckets_are_one_random_order(spark):
    frame = documents(spark, 2000)
    rows = shuffled(frame, ["doc_id"], 10, bucket_bytes=3000).collect()
    check(rows, 2000, 10)
    order = [r.row.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order)
    # neighbours in the order are no neighbours in the input, and a shard holds all parts of it
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:], strict=False)) < 20
    assert all(60 < sum(i < 1000 for i in order[k : k + 200]) < 140 for k in range(0, 2000, 200))


def test_reruns_agree_and_seeds_differ(spark):
    frame = documents(spark)
    place = lambda f, **k: {r.row.doc_id: (r.shard, r.slot) for r in shuffled(f, ["doc_id"], bucket_bytes=2000, **k).collect()}
    assert place(frame) == place(frame.repartition(9)) != place(frame, seed=2)


def test_odd_rows(spark):
    rows = [(None, None)] * 5 + [(None, "")] * 3 + [(1, "x")] * 4 + [(2, "y" * 100_000)]
    got = shard_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    check(got, 13, 24)
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter({(None, 8): 8, (1, 9): 4, (2, 100_008): 1})
    assert shard_rows(spark.createDataFrame([], SCHEMA)).collect() == []


def test_written_shards(spark, tmp_path):
    frame = documents(spark).selectExpr("*", "doc_id as bucket", "text as `row`", "doc_id as place")
    write_shards(frame, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    check(back.collect(), 500, 4)
    assert sorted(back.columns) == sorted([*frame.columns, "shard", "slot"])


def test_several_buckets_in_a_partition(spark):
    frame = documents(spark, 2000)
    few = shuffled(frame, ["doc_id"], 10, bucket_bytes=3000, partitions=3)
    check(few.collect(), 2000, 10)
    order = [r.row.doc_id for r in sorted(few.collect(), key=lambda r: (r.shard, r.slot))]
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:], strict=False)) < 20
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, shuffled(frame.repartition(5), ["doc_id"], 10, bucket_bytes=3000, partitions=3).collect()))


def test_equal_rows_are_dealt_over_the_buckets(spark):
    frame = spark.range(20_000).selectExpr("cast(null as long) doc_id", "'a text of nobody' text").unionByName(documents(spark, 100))
    rows = shuffled(frame, ["doc_id"], 4, bucket_bytes=20_000)
    check(rows.collect(), 20_100, 4)
    # more than one bucket's worth of equal rows: each shard holds its share
    named = [r for r in rows.collect() if r.row.doc_id is not None]
    assert min(Counter(r.shard for r in named).values()) > 10


def test_whole_records_go_through_both_passes(spark, monkeypatch):
    """What the buckets gather and shuffle are the records with their texts, not their ids beside facts known before."""
    seen, passes = [], sharding.shuffled
    monkeypatch.setattr(sharding, "shuffled", lambda *a, **k: seen.append(passes(*a, **k)) or seen[-1])
    frame = documents(spark).selectExpr("*", "concat('source ', doc_id) as source")
    placed = shard_rows(frame)
    assert [f.schema["row"].dataType.names for f in seen] == [frame.columns]
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "crc32" not in plan[plan.index("collect_list") :]
    text = {r.doc_id: r.text for r in frame.collect()}
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in placed.collect())
