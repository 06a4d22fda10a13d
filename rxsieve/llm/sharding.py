"""Sharding by an external shuffle in two passes, in DataFrame expressions only.

Pass one scatters the records by a seeded hash into buckets that fit in memory: the exchange. Pass two gathers each bucket,
puts it in a fixed order and runs a Fisher-Yates shuffle over it (Spark's ``shuffle`` with a seed). The buckets in their order
are then one random order of all records, which is cut into shards of equal numbers of rows.

A partition is one bucket or some buckets in their order (``repartitionById``), and the draws depend on the seed and the partition only, so
a lost task or a rerun gives the same order.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxsieve.llm.copies import repeated_kinds, with_copy
from rxsieve.llm.store import stored

SHARDS = 24
#: Bytes of text in a bucket, on average.
BUCKET_BYTES = 8 << 20
#: Partitions at most: beyond, one holds several buckets, which it shuffles one after the other.
PARTITIONS = 50_000


def shuffled(docs: DataFrame, carried: list[str] | None = None, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = 1, partitions: int = PARTITIONS) -> DataFrame:
    """Per row ``row`` (its ``carried`` columns, all unless they are named), ``shard``, ``slot``.

    ``docs`` has ``doc_id`` and ``text``. The shards' numbers of rows differ by one at most, and the slots of each run from 0 without a
    gap. Ids and texts may be NULL or repeat; rows alike in both are dealt over the buckets by where they stand in the table, which is written first if it has such rows. The
    carried columns must be of types that can be sorted. No rows give no rows.
    """
    bytes_, total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8), F.count("*")).first()
    if not total:
        return docs.select(F.struct(*(carried or docs.columns)).alias("row"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    buckets = math.ceil(bytes_ / bucket_bytes)
    alike = ["doc_id", "text"]
    whole = docs.select("doc_id", "text", F.struct(*(carried or docs.columns)).alias("row"))
    if repeated_kinds(docs, alike).limit(1).count():
        whole = stored(with_copy(whole, alike), "copies")
        alike.append("copy")
    bucket = F.pmod(F.xxhash64(F.lit(seed), *alike), F.lit(buckets)).cast("int")
    rows = whole.select(bucket.alias("bucket"), "row")

    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "bucket-offsets")

    together = math.ceil(buckets / partitions)
    dealt = rows.withColumn("part", F.expr(f"bucket div {together}").cast("int")).repartitionById(math.ceil(buckets / together), F.col("part"))
    gathered = dealt.groupBy("part", "bucket").agg(F.array_sort(F.collect_list("row")).alias("members")).sortWithinPartitions("bucket")
    mixed = gathered.select("bucket", F.shuffle("members", F.lit(seed)).alias("members"))
    placed = mixed.join(offsets, "bucket").select("offset", F.posexplode("members").alias("at", "row"))
    place = F.col("offset") + F.col("at")
    exact = placed.select("row", place.alias("place")).withColumn("shard", F.expr(f"cast(place * {shards} div {total} as int)"))
    return exact.select("row", "shard", (F.col("place") - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")).alias("slot"))


def shard_rows(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    Whole records go through both passes, as in ``write_shards``; size and checksum are those of the text that comes out of them.
    """
    placed = shuffled(docs).select("row.doc_id", F.coalesce("row.text", F.lit("")).alias("text"), "shard", "slot")
    size, crc = (F.octet_length("text") + 8).cast("long"), F.crc32(F.col("text").cast("binary"))
    return placed.select("doc_id", size.alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the rows, whatever their columns, as Parquet in one folder for each shard, each file in the order of ``slot``."""
    placed = shuffled(docs, shards=shards)
    clash = {"shard", "slot"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns of these names hold the place: {sorted(clash)}")
    placed.select("row.*", "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
