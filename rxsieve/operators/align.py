"""Aligns a frame with the schema of the table it will be appended to.

Schemas are compared while the plan is built; no job runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxsieve.functions.cells import cell, printable
from rxsieve.params import CampaignParams

# Type classes of the column metadata.
NUMERIC, CHARACTER = 1, 2
CHARACTER_TYPES = (T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)

# Columns the append fills itself, and the campaign whose data is loaded as it is.
ROW_ID, LOAD_TIME = "row_gid", "dqi_ts"
UNCLEANED_CAMPAIGN = 99


@dataclass(frozen=True)
class ColumnInfo:
    name: str
    varnum: int
    type: int
    format: str
    length: str


def column_metadata(schema: T.StructType) -> list[ColumnInfo]:
    """Name, position, type class, type and nullability of every column, in table order."""
    return [
        ColumnInfo(
            field.name.lower(),
            i,
            CHARACTER if isinstance(field.dataType, CHARACTER_TYPES) else NUMERIC,
            field.dataType.simpleString(),
            "NULLABLE" if field.nullable else "REQUIRED",
        )
        for i, field in enumerate(schema.fields)
    ]


def unmatched_columns(source: T.StructType, target: T.StructType) -> list[str]:
    """Target columns the source lacks, in target order."""
    have = {name.lower() for name in source.names}
    return [name.lower() for name in target.names if name.lower() not in have]


def lower_names(frame: DataFrame) -> DataFrame:
    return frame.toDF(*[c.lower() for c in frame.columns])


def strip_unprintable(frame: DataFrame, run: CampaignParams) -> DataFrame:
    """Drops every character outside printable ASCII from the text columns."""
    if run.campaign_id == UNCLEANED_CAMPAIGN:
        return frame
    texts = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]
    return frame.withColumns({c: printable(c) for c in texts})


def default_value(data_type: T.DataType) -> Column:
    """Empty text for text columns and a typed NULL otherwise: '' is no date or number."""
    return F.lit("") if isinstance(data_type, T.StringType) else F.lit(None).cast(data_type)


def align_to_target(source: DataFrame, target: T.StructType) -> DataFrame:
    """The target's columns in the target's order, absent ones filled with defaults."""
    renamed = lower_names(source)
    absent = set(unmatched_columns(source.schema, target))
    return renamed.select(
        *[
            default_value(f.dataType).alias(f.name.lower()) if f.name.lower() in absent else cell(f.name.lower())
            for f in target.fields
        ]
    )


def load_time(run: CampaignParams) -> Column:
    """The run's time; a time without zone is read in the session's zone."""
    return F.current_timestamp() if run.run_ts is None else F.lit(run.run_ts.isoformat()).cast("timestamp")


def append_projection(frame: DataFrame, run: CampaignParams) -> DataFrame:
    """Columns as an append selects them: the row id is 1, the load time is the run's."""
    special = {ROW_ID: F.lit(1), LOAD_TIME: load_time(run)}
    return frame.select(*[special.get(c.lower(), cell(c)).alias(c.lower()) for c in frame.columns])


def schema_difference(source: DataFrame, target: T.StructType) -> DataFrame:
    """The columns of both schemas side by side, in the target's order, those only the source has behind.

    ``name``, ``source_varnum`` and ``target_varnum`` (position), ``source_type`` and ``target_type`` (type class), ``match`` (``both``, ``source`` or ``target``)
    and ``n_filled``: the source's rows with a value there, which an append carries over, drops, or fills in (0 for a column only the target has).
    """
    spark = source.sparkSession

    def described(schema: T.StructType, side: str) -> DataFrame:
        rows = [(c.name, c.varnum, c.type) for c in column_metadata(schema)]
        return spark.createDataFrame(rows, f"name string, {side}_varnum int, {side}_type int")

    ours, theirs = described(source.schema, "source"), described(target, "target")
    counts = F.array(*[F.struct(F.lit(c.lower()).alias("name"), F.count(cell(c)).alias("n_filled")) for c in source.columns])
    filled = source.agg(counts.alias("counts")).select(F.inline("counts"))
    both = ours.join(filled, "name").join(theirs, "name", "full")
    match = F.when(F.col("target_varnum").isNull(), "source").when(F.col("source_varnum").isNull(), "target").otherwise("both")
    rows = both.select("name", "source_varnum", "target_varnum", "source_type", "target_type", match.alias("match"), F.coalesce("n_filled", F.lit(0)).alias("n_filled"))
    return rows.orderBy(F.col("target_varnum").asc_nulls_last(), "source_varnum")
