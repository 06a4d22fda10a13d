"""Numbers that tell rows alike apart, so that a large group of them can be dealt out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def repeated_kinds(rows: DataFrame, by: list[str]) -> DataFrame:
    """``kind`` (a hash of the columns ``by``) and ``alike``, its number of rows, where that is more than one."""
    return rows.select(F.xxhash64(*by).alias("kind")).groupBy("kind").agg(F.count("*").alias("alike")).where("alike > 1")


def with_copy(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with ``copy``: 0 for a row alone in its kind, else a number below the kind's number of rows that spreads them evenly.

    The number comes from where a row stands in the table: write the rows before they are used twice. Nothing is gathered by kind.
    """
    named = rows.withColumn("_kind", F.xxhash64(*by))
    kinds = repeated_kinds(rows, by)
    copy = F.when(F.col("alike").isNull(), 0).otherwise(F.pmod(F.xxhash64(F.monotonically_increasing_id()), "alike")).alias("copy")
    return named.join(kinds, F.col("_kind") == F.col("kind"), "left").select(*(F.col(f"`{c}`") for c in rows.columns), copy)
