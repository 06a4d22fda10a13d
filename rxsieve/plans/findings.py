"""From reports to issues: how many rows each check found and what that raises."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxsieve.operators.checks import finding_counts
from rxsieve.params import CampaignParams


@dataclass(frozen=True)
class Check:
    """A check stops the later ones of its job when it finds rows."""

    job: str
    seq: int
    name: str
    message_id: int


# Message ids raised by the checks, in the order the jobs run them.
DUPLICATES = Check("intake", 1, "duplicates", 5)
EXCLUSIONS = Check("intake", 2, "invalid_exclusions", 6)
QUALITY = Check("quality", 1, "quality", 21)
TARGET_INDICATOR = Check("quality", 2, "target_indicator", 74)


COUNTS = "job string, check_seq int, check_name string, message_id int, n_rows long"


def _count(check: Check, n_rows: Column) -> Column:
    named = {"job": check.job, "check_seq": check.seq, "check_name": check.name, "message_id": check.message_id}
    return F.struct(*[F.lit(v).alias(k) for k, v in named.items()], n_rows.cast("long").alias("n_rows"))


def check_counts(findings: dict[Check, DataFrame], validity: DataFrame | None = None) -> DataFrame:
    """One row per check with its row count; all checks are counted in one job.

    With the pruned matches in ``validity`` the intake's checks are counted from them in one pass, and ``findings`` holds the others.
    """
    counts = [rows.agg(F.array(_count(check, F.count("*"))).alias("counts")) for check, rows in findings.items()]
    if validity is not None:
        both = F.array(_count(DUPLICATES, F.col("duplicates")), _count(EXCLUSIONS, F.col("exclusions")))
        counts.append(finding_counts(validity).select(both.alias("counts")))
    return reduce(DataFrame.unionByName, counts).select(F.inline("counts"))


def observed_counts(spark: SparkSession, counts: dict[Check, int]) -> DataFrame:
    """The rows of ``check_counts`` from counts that are known already."""
    return spark.createDataFrame([(c.job, c.seq, c.name, c.message_id, n) for c, n in counts.items()], COUNTS)


def first_failures(counts: DataFrame) -> DataFrame:
    """The check each job stops at: the first that found rows."""
    return (
        counts.filter(F.col("n_rows") > 0)
        .groupBy("job")
        .agg(F.min(F.struct("check_seq", "check_name", "message_id", "n_rows")).alias("stop"))
        .select("job", "stop.*")
    )


def raised_issues(counts: DataFrame, run_id: int, run: CampaignParams) -> DataFrame:
    """Issues for the disposition, one per check that found rows."""
    return counts.filter(F.col("n_rows") > 0).select(
        F.lit(run_id).cast("long").alias("run_id"),
        F.col("check_seq").cast("long").alias("seq"),
        F.lit(run.campaign_id).alias("campaign_id"),
        "message_id",
        F.col("check_name").alias("message_text"),
    )
