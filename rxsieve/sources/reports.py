"""Reports of offending rows, one folder per check."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rxsieve.params import CampaignParams

# Report names; campaigns whose quality report carries a prefix.
QUALITY_REPORT = "validate_drug_quality"
TARGET_INDICATOR_REPORT = "validate_drug_tgt_ind"
DUPLICATE_REPORT = "validate_drug_duplicates"
EXCLUSION_REPORT = "validate_drug_exclusions"
PROGRAM_TYPE_CAMPAIGNS = (557,)
FORMULARY_RUN_TYPE_CAMPAIGNS = (553, 562)


def quality_report_name(run: CampaignParams) -> str:
    if run.campaign_id in PROGRAM_TYPE_CAMPAIGNS:
        return f"{run.program_type}_{QUALITY_REPORT}"
    if run.campaign_id in FORMULARY_RUN_TYPE_CAMPAIGNS:
        return f"{run.formulary_run_type}_{QUALITY_REPORT}"
    return QUALITY_REPORT


def write_report(rows: DataFrame, folder: str, name: str, fmt: str = "csv", order_by: list[str] | None = None) -> str:
    """Write a report in parallel, sorted if asked, and return its path."""
    return _written(rows.orderBy(*order_by) if order_by else rows, folder, name, fmt)


def write_counted_report(rows: DataFrame, folder: str, name: str, fmt: str = "csv", order_by: list[str] | None = None) -> tuple[str, int]:
    """Write a report and count its rows while they are written; a report without rows is taken away again."""
    counted = Observation()
    # above the sort: what lies below it runs once more for its sample
    ordered = rows.orderBy(*order_by) if order_by else rows
    path = _written(ordered.observe(counted, F.count(F.lit(1)).alias("n")), folder, name, fmt)
    count = counted.get["n"]
    if not count:
        file = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        file.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).delete(file, True)
    return path, count


def _written(rows: DataFrame, folder: str, name: str, fmt: str) -> str:
    path = f"{folder.rstrip('/')}/{name}"
    writer = rows.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path
