"""A campaign run from its checks to the decision: reports, issues, disposition, flags."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxsieve.operators.disposition import dispose_issues, run_flags
from rxsieve.params import CampaignParams
from rxsieve.plans import findings
from rxsieve.plans.findings import Check
from rxsieve.plans.intake import IntakeResult, checked
from rxsieve.plans.quality import QualityResult
from rxsieve.sources import reports, tables

# Fixed value: the name of the matches beside the reports.
MATCHES = "drug_validity"

# The order of each report; reports without one are written as they come.
ORDERED_BY = {findings.DUPLICATES: ["rec_type", "drug_id"], findings.EXCLUSIONS: ["drug_id"]}


@dataclass(frozen=True)
class CampaignResult:
    counts: DataFrame
    issues: DataFrame
    disposed: DataFrame
    flags: DataFrame
    reports: list[str] = field(default_factory=list)
    # the intake that was reported on, read from its written matches if there are any
    intake: IntakeResult | None = None


def report_name(check: Check, run: CampaignParams) -> str:
    names = {
        findings.DUPLICATES: reports.DUPLICATE_REPORT,
        findings.EXCLUSIONS: reports.EXCLUSION_REPORT,
        findings.QUALITY: reports.quality_report_name(run),
        findings.TARGET_INDICATOR: reports.TARGET_INDICATOR_REPORT,
    }
    return names[check]


def report_rows(check: Check, rows: DataFrame, run: CampaignParams) -> DataFrame:
    """The rows of a check's report, in its order, with the name of the report."""
    named = rows.withColumn("report_name", F.lit(report_name(check, run)))
    return named.orderBy(*ORDERED_BY[check]) if check in ORDERED_BY else named


def write_reports(found: dict[Check, DataFrame], folder: str, run: CampaignParams, fmt: str = "csv") -> tuple[dict[Check, int], list[str]]:
    """Write a report for each check that finds rows, counting them on the way; the counts of all checks, and the paths in the order of the checks."""
    counts, written = {}, []
    for check, rows in found.items():
        path, counts[check] = reports.write_counted_report(rows, folder, report_name(check, run), fmt, ORDERED_BY.get(check))
        if counts[check]:
            written.append(path)
    return counts, written


def conclude(
    intake: IntakeResult,
    quality: QualityResult,
    messages: DataFrame,
    campaigns: DataFrame,
    run: CampaignParams,
    run_id: int = 0,
    folder: str | None = None,
) -> CampaignResult:
    """What the checks of a run found and what follows.

    With ``folder`` the matches are written there as ``drug_validity`` and the reports of failing checks beside them. So the match runs once, each check is one more pass
    over its result, and everything after them works on counts that were taken while the reports were written. Without, nothing runs yet.
    """
    if folder is None:
        if intake.derived:
            counts = findings.check_counts(quality.findings, intake.validity)
        else:
            counts = findings.check_counts(intake.findings | quality.findings)
        written: list[str] = []
    else:
        spark = intake.validity.sparkSession
        if intake.derived:
            intake = checked(tables.read_parquet(spark, reports.write_report(intake.validity, folder, MATCHES, "parquet")))
        counted, written = write_reports(intake.findings | quality.findings, folder, run)
        counts = findings.observed_counts(spark, counted)
    issues = findings.raised_issues(counts, run_id, run)
    disposed = dispose_issues(issues, messages, campaigns, run)
    return CampaignResult(counts, issues, disposed, run_flags(disposed), written, intake)
