"""Loads frames into existing tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rxsieve.operators.align import ROW_ID, align_to_target, append_projection, strip_unprintable, unmatched_columns
from rxsieve.operators.history import history_rows
from rxsieve.params import CampaignParams
from rxsieve.sources import tables

# The partition column of a history that keeps its runs apart.
RUN_KEY = "run_key"


def prepare_load(source: DataFrame, target: DataFrame, run: CampaignParams) -> DataFrame:
    """The source cleaned and shaped like the target, ready to append."""
    return append_projection(align_to_target(strip_unprintable(source, run), target.schema), run)


class Loaded(NamedTuple):
    """Columns only the target has; they were filled with defaults."""

    count: int
    names: list[str]


def load_table(source: DataFrame, target: str, run: CampaignParams) -> Loaded:
    table = tables.read_table(source.sparkSession, target)
    tables.append_by_position(prepare_load(source, table, run), target)
    absent = unmatched_columns(source.schema, table.schema)
    return Loaded(len(absent), absent)


def history_name(run: CampaignParams, schema: str | None = None) -> str:
    target = tables.history_table(run)
    return f"{schema}.{target}" if schema else target


def append_history(variables: DataFrame, run: CampaignParams, run_key: str, schema: str | None = None, logged_at: Column | None = None) -> str:
    """Append a run's variables to a history table with a partition for each run, and return its name; the table is made if it is not there.

    A run that is recorded again replaces what it recorded before, and the partitions of other runs are not touched.
    """
    spark, target = variables.sparkSession, history_name(run, schema)
    rows = history_rows(variables, run, logged_at).withColumn(RUN_KEY, F.lit(run_key))
    if not tables.table_exists(spark, target):
        tables.replace_table(rows.limit(0), target, partitions=[RUN_KEY])
    recorded = Observation()
    tables.overwrite_partitions(rows.observe(recorded, F.count(F.lit(1)).alias("n")), target)
    if not recorded.get["n"]:
        # nothing to overwrite with
        tables.drop_partition(spark, target, {RUN_KEY: run_key})
    tables.refresh_statistics(spark, target, ROW_ID)
    return target


def record_variables(spark: SparkSession, source: str, run: CampaignParams, schema: str | None = None) -> bool:
    """Append a run's variables to its history table; false when there is nothing to record."""
    if not tables.table_exists(spark, source):
        return False
    target = history_name(run, schema)
    tables.append_by_position(history_rows(tables.read_table(spark, source), run), target)
    tables.refresh_statistics(spark, target, ROW_ID)
    return True
