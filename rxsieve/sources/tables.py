"""Catalog tables: reading, testing, appending, statistics."""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rxsieve.params import CampaignParams

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def replace_table(frame: DataFrame, name: str, by: list[str] | None = None, buckets: int = 0, partitions: list[str] | None = None) -> None:
    """Create the table from the frame, replacing an older one.

    With ``buckets`` the rows lie in so many buckets by the columns ``by``, sorted by them, so that groups and joins by these columns need no exchange. A bucket
    is read by one task: for rows of which one value of ``by`` has a large share, leave them out. ``partitions`` are columns with few values.
    """
    if buckets:
        # one task a bucket, so one file each
        frame = frame.repartition(buckets, *by)
    writer = frame.write.mode("overwrite")
    if buckets:
        writer = writer.bucketBy(buckets, by[0], *by[1:]).sortBy(by[0], *by[1:])
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(name)


def table_partitions(rows: DataFrame, partitions: list[str]) -> list[Row]:
    """The distinct values of partition columns; a table has few partitions."""
    return rows.select(*partitions).distinct().collect()


def _one_of(partitions: list[str], values: list[Row]) -> Column:
    same = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(row[c])) for c in partitions]) for row in values]
    return reduce(Column.__or__, same, F.lit(False))


def overwrite_partitions(frame: DataFrame, name: str) -> None:
    """Replace the partitions that the frame has rows of, and no others; columns go by position, partition columns last."""
    conf, before = frame.sparkSession.conf, frame.sparkSession.conf.get(OVERWRITE_MODE)
    # insertInto takes it from the session alone
    conf.set(OVERWRITE_MODE, "dynamic")
    try:
        frame.write.insertInto(name, overwrite=True)
    finally:
        conf.set(OVERWRITE_MODE, before)


def drop_partition(spark: SparkSession, name: str, partition: dict[str, object]) -> None:
    """Drop a partition, given by a value for each partition column, if it is there."""
    # the statement takes no parameters
    text = {c: "NULL" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" for c, v in partition.items()}
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({', '.join(f'`{c}` = {v}' for c, v in text.items())})")


def delete_rows(spark: SparkSession, name: str, gone: Column, partitions: list[str]) -> int:
    """Delete the rows of a partitioned table for which ``gone`` is true, and return how many partitions lost some.

    Only those partitions are written anew; the files of the others stay. An unknown condition keeps the row.
    """
    rows = spark.table(name)
    gone = F.coalesce(gone, F.lit(False))
    losing = table_partitions(rows.filter(gone), partitions)
    if not losing:
        return 0
    touched = rows.filter(_one_of(partitions, losing))
    left = touched.filter(~gone)
    kept = set(table_partitions(left, partitions))
    overwrite_partitions(left, name)
    for row in losing:
        if row not in kept:
            drop_partition(spark, name, row.asDict())
    return len(losing)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": name})


def append_by_position(frame: DataFrame, name: str) -> None:
    """Append rows; columns go by position, whatever their names."""
    frame.write.insertInto(name)


def refresh_statistics(spark: SparkSession, name: str, column: str) -> None:
    names = {"name": name, "column": column}
    spark.sql("ANALYZE TABLE IDENTIFIER(:name) COMPUTE STATISTICS FOR COLUMNS IDENTIFIER(:column)", names)


class ColumnStatistics(NamedTuple):
    row_count: int
    distinct_count: int
    null_count: int


def read_statistics(spark: SparkSession, name: str, column: str) -> ColumnStatistics:
    """What the catalog knows of a column since it was last analysed; the distinct count is an estimate."""
    of_table = spark.sql("DESCRIBE EXTENDED IDENTIFIER(:name)", {"name": name}).filter(F.col("col_name") == "Statistics").first()
    rows = int(re.search(r"(\d+) rows", of_table.data_type).group(1))
    # DESCRIBE takes no parameter for a column
    quoted = "`" + column.replace("`", "``") + "`"
    of_column = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED IDENTIFIER(:name) {quoted}", {"name": name}).collect()}
    return ColumnStatistics(rows, int(of_column["distinct_count"]), int(of_column["num_nulls"]))


def history_table(run: CampaignParams) -> str:
    return run.production_history if run.production == "Y" else run.development_history
