"""Lookups by id with a default."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(frame: DataFrame, key: str, values: list[str]) -> DataFrame:
    """One record per key, the least by its values: the same pick on every run."""
    record = F.min(F.struct(*[F.col(v).alias(v) for v in values])).alias("record")
    return frame.filter(F.col(key).isNotNull()).groupBy(key).agg(record).select(key, "record.*")
