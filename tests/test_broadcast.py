"""No query that reads matches sends a table through the driver, whatever its size."""

import pytest
from pyspark.sql import functions as F

from rxsieve.workload.queries import QUERIES

LIMIT = "spark.sql.maxBroadcastTableSize"
READ_MATCHES = [
    "match_gpi", "match_ndc11", "drug_validity", "drug_validity_mony", "prune_generic", "prune_mony", "prune_stored",
    "dup_groups", "inclusions", "exclusions", "raised_issues",
]


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("parts"))
    key = F.col("p_partkey")
    rows = spark.range(240).select(
        F.col("id").alias("p_partkey"),
        F.concat(F.lit("part "), F.col("id")).alias("p_name"),
    )
    rows = rows.withColumns({"p_brand": F.concat(F.lit("Brand#"), 11 + key % 5), "p_type": F.lit("SMALL"), "p_size": (1 + key % 4).cast("int")})
    rows.write.parquet(f"{folder}/part.parquet")
    return folder


@pytest.mark.parametrize("name", READ_MATCHES)
def test_no_table_is_broadcast(spark, parts, name):
    """A broadcast of a single byte fails, so what is done inside a query, as the writing of a table, is held to it as well."""
    spark.conf.set(LIMIT, "1")
    try:
        assert QUERIES[name](spark, parts).collect()
    finally:
        spark.conf.unset(LIMIT)
