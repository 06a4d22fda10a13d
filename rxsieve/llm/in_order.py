"""Rows in a global order, cut into parts that tasks work on one by one.

A hot group is spread over several parts, because the order goes on below the group. What a part must know of the parts before or behind it
is a row for each part, so it passes the driver in a size that depends on the number of parts alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxsieve.llm.store import stored


def in_order(rows: DataFrame, order: list[Column | str], work: Callable, schema: str, name: str) -> DataFrame:
    """``rows`` in their order, worked on part by part, written to the shared folder.

    ``work`` takes the batches of a part as ``mapInArrow`` does; their column ``part`` rises with the order. Rows alike in ``order`` are
    dealt over parts as well, so they should be interchangeable. Parts without rows give none.
    """
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order, "_tie").drop("_tie").sortWithinPartitions(*order)
    return stored(ranged.withColumn("part", F.spark_partition_id()).mapInArrow(work, schema), name)


def summaries(parts: DataFrame) -> list:
    """The last row of each part, in order: its ``seq`` is -1, and it tells the others what they must know of the part."""
    return sorted(parts.where("seq < 0").collect(), key=lambda r: r.part)
