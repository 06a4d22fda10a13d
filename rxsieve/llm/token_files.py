"""Token ids in files, compressed by a Re-Pair grammar for each block.

The format is a Parquet dataset with one row for each block of about ``CHUNK_BYTES`` of text, in the order of ``shard`` and
``block``; documents are in ascending doc_id order throughout. Columns:

* ``shard``, ``block``: the range of doc_ids, and the block's place in it
* ``first``: ids of the shard before the block; ``n_ids``: ids in it
* ``doc_ids``; ``ids_before``: ids of the block before each document; ``symbol_ends``: symbols up to the end of each
* ``first_rule``, ``rules``, ``lengths``, ``symbols``: the grammar, as little-endian unsigned 32-bit integers

Spark's writer commits whole tasks, so a lost executor leaves no half-written block.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rxsieve.llm import grammar as g
from rxsieve.llm import words as w
from rxsieve.llm.pretokens import CHUNK_BYTES, classes, shared_encoder
from rxsieve.llm.store import new_path, stored

END = 0
#: Short, for the bounds of the shards pass the driver.
PREFIX = 16
SCHEMA = "shard int, block int, first long, n_ids long, doc_ids array<long>, ids_before array<long>, symbol_ends array<int>, first_rule int, rules binary, lengths binary, symbols binary"


def _list(values, kind: pa.DataType) -> pa.Array:
    return pa.array([np.asarray(values)], pa.list_(kind))


def write_token_files(docs: DataFrame, tokenizer_file: str, path: str, shards: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text; other columns are ignored), append ``END`` to each and write the files.

    There are ``shards`` ranges of doc_ids, or else as many as Spark's settings make of the size
    (``spark.sql.shuffle.partitions``, which adaptive execution joins to its advisory size).

    NULL and empty texts are the end id alone. Rows without doc_id come first; rows that repeat a doc_id follow each other by the first ``PREFIX`` characters of
    their texts and then a hash of them.
    No documents leave a dataset without rows.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast((file.read(), classes(), {}))

    def encode(batches):
        encoder = shared_encoder(shared.value)
        block, first = 0, 0
        for batch, data, offsets in w.chunks(batches, limit=CHUNK_BYTES):
            ids, before = encoder.encode(data, offsets)
            count = len(batch)
            before = before + np.arange(count + 1)
            with_end, own = np.full(before[-1], END, np.uint32), np.ones(before[-1], bool)
            own[before[1:] - 1] = False
            with_end[own] = ids
            made = g.compress(with_end, before[1:])
            binary = lambda x: pa.array([x.astype("<u4").tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard").slice(0, 1), pa.array([block], pa.int32()), pa.array([first]), pa.array([len(with_end)]),
                 _list(batch.column("doc_id"), pa.int64()) if not batch.column("doc_id").null_count else pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 _list(before[:-1], pa.int64()), _list(made.ends, pa.int32()), pa.array([made.first_rule], pa.int32()), binary(made.rules), binary(made.lengths), binary(made.symbols)],
                [f.split()[0] for f in SCHEMA.split(", ")],
            )
            block, first = block + 1, first + len(with_end)

    texts = docs.select("doc_id", "text").withColumn("tie", F.monotonically_increasing_id())
    order = [F.col("doc_id"), F.substring("text", 1, PREFIX), F.xxhash64("text")]
    # rows of one id, or without one, are dealt over shards by their texts, and rows alike by the tie
    ranged = texts.repartitionByRange(*([shards] if shards else []), *order, "tie").drop("tie")
    ranged.sortWithinPartitions(*order).withColumn("shard", F.spark_partition_id()).mapInArrow(encode, SCHEMA).write.option("compression", "zstd").parquet(path)


def _shard_starts(blocks: DataFrame) -> DataFrame:
    """``shard`` and ``shard_start``, the ids in all shards before it; one row for each shard."""
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))


def _read(blocks: DataFrame, kind: str, give) -> DataFrame:
    """Per document ``doc_id``, ``at`` (ids of the shard before it), ``n_tokens`` and what ``give`` makes of its ids as bytes."""

    def decode(batches):
        for batch in batches:
            for row in range(len(batch)):
                block = {n: batch.column(n)[row] for n in batch.schema.names}
                numbers = lambda n: np.frombuffer(block[n].as_py(), "<u4")  # noqa: B023, E731
                ids = g.expand(numbers("symbols"), block["first_rule"].as_py(), numbers("rules").reshape(-1, 2), numbers("lengths")).astype("<u4")
                before = np.append(block["ids_before"].values.to_numpy(), len(ids))
                values = [give(ids[a:b].tobytes()) for a, b in zip(before[:-1], before[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block["shard"].as_py()] * len(values), pa.int32()), block["doc_ids"].values, pa.array(before[:-1] + block["first"].as_py()), pa.array(np.diff(before)), pa.array(values)],
                    ["shard", "doc_id", "at", "n_tokens", "value"],
                )

    return blocks.mapInArrow(decode, f"shard int, doc_id long, at long, n_tokens long, value {kind}")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``, from the files alone."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    starts = stored(_shard_starts(blocks), "shard-starts")
    found = _read(blocks, "long", zlib.crc32).join(starts, "shard")
    return found.select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", F.col("value").alias("ids_crc32"))


def token_file_rows(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Write the documents' token files to the shared folder and return what is read back."""
    path = new_path(docs.sparkSession, "token-files")
    write_token_files(docs, tokenizer_file, path)
    return read_token_files(docs.sparkSession, path)
