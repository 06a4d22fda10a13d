"""Session settings the wide rule projections profit from."""

from __future__ import annotations

from pyspark.sql import SparkSession

# HotSpot compiles no method above 8000 bytes of bytecode. Past that size Spark should split the code
# of a wide projection instead of fusing it into one method that then runs interpreted.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tuned(spark: SparkSession) -> SparkSession:
    """Apply the settings that the session has not been given, at its start or since."""
    for key, value in SETTINGS.items():
        if key not in spark.conf.getAll:
            spark.conf.set(key, value)
    return spark


def partitions(spark: SparkSession) -> int:
    """How many parts the session deals rows to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
