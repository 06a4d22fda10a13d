"""One registered query per operator, over the stand-in inputs."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxsieve import params as p
from rxsieve.operators import align, checks, disposition, match, quality, summary
from rxsieve.operators.history import history_rows
from rxsieve.operators.normalize import normalize_drug_rows
from rxsieve.params import CampaignParams
from rxsieve.plans import campaign, findings
from rxsieve.plans.intake import IntakeResult, pruned_validity, validate_intake
from rxsieve.plans.load import append_history, prepare_load
from rxsieve.plans.quality import validate_drugs
from rxsieve.session import tuned
from rxsieve.sources import tables
from rxsieve.workload import inputs

Query = Callable[[SparkSession, str], DataFrame]

GENERIC = CampaignParams(campaign_id=30)
MONY = CampaignParams(campaign_id=66)
LOAD = CampaignParams(campaign_id=30, run_ts=dt.datetime(2024, 1, 1, 12, 30, 15, 250000))
RUN = CampaignParams(campaign_id=30, main_dir="/jobs/prod", email_subject="drug intake")
TEST_RUN = CampaignParams(campaign_id=30, main_dir="/jobs/bss_test/x", email_subject="drug intake")

NORMALIZED_DEFAULTS = ["row_no", "age_min", "age_max", "b_g", "ms_ss", "drugcat"]
NORMALIZED_CODES = [
    "row_no", "gpi", "gpi_raw", "ndc11", "ndc11_raw", "ndc9", "gpi_len", "drug_sub", "druglvl", "drug_code", "sql_join",
]
NORMALIZED_LIMITS = ["row_no", "b_g", "ms_ss", "_exceed_rlimit", "_exceed_mlimit", "rlimit", "mlimit"]

DATES = ("EFFECTIVE DATE", "EFF_DATE")

LOAD_TARGET = T.StructType(
    [
        T.StructField("row_gid", T.IntegerType()),
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("memo", T.StringType()),
        T.StructField("opened", T.DateType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("dqi_ts", T.TimestampType()),
    ]
)

# Quality queries: input family and the run that switches its rules on.
QUALITY_RUNS: dict[str, tuple[str, CampaignParams]] = {
    "quality_common": ("common", CampaignParams(campaign_id=24)),
    "quality_fdro": ("fdro", CampaignParams(campaign_id=30)),
    "quality_fdro_in_context": ("fdro", CampaignParams(campaign_id=63, context=p.INTAKE_FDRO_ANA)),
    "quality_acf": ("acf", CampaignParams(campaign_id=26)),
    "quality_acf_second_file": ("acf", CampaignParams(campaign_id=63)),
    "quality_bc": ("bc", CampaignParams(campaign_id=566)),
    "quality_tier": ("common", CampaignParams(campaign_id=60)),
    "quality_exchange": ("exchange", CampaignParams(campaign_id=20)),
    "quality_gstp": ("gstp", CampaignParams(campaign_id=28)),
    "quality_balance": ("balance", CampaignParams(campaign_id=67)),
    "quality_bf": ("balance", CampaignParams(campaign_id=66)),
    "quality_ib": ("acf", CampaignParams(campaign_id=54, bob_run_type="IB")),
    "quality_intake_limits": ("intake", CampaignParams(campaign_id=24, context=p.INTAKE)),
    "quality_vf": ("vf", CampaignParams(campaign_id=567)),
    "quality_opioid": ("opioid", CampaignParams(campaign_id=52)),
}


def _input(sql: str) -> Query:
    return lambda spark, sf: inputs.read_input(spark, sf, sql)


catalog, intake, formulary = _input(inputs.CATALOG), _input(inputs.INTAKE), _input(inputs.FORMULARY)
campaigns, messages, issues = _input(inputs.CAMPAIGNS), _input(inputs.MESSAGES), _input(inputs.ISSUES)
projects, runs = _input(inputs.PROJECTS), _input(inputs.RUNS)


def raw_rows(family: str, spread: bool = True) -> Query:
    return lambda spark, sf: inputs.read_input(tuned(spark), sf, inputs.family_rows(family), spread)


def _normalized(run: CampaignParams, columns: list[str]) -> Query:
    return lambda spark, sf: normalize_drug_rows(raw_rows("common", spread=False)(spark, sf), run).select(*columns)


def _matched(level: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return match.match_products(intake(spark, sf).filter(F.col("druglvl") == level), catalog(spark, sf))

    return query


def _validity(run: CampaignParams, pruned: bool) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = match.drug_validity(intake(spark, sf), catalog(spark, sf), run)
        return checks.prune_matches(rows, run) if pruned else rows

    return query


def _checked(check: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: check(pruned_validity(intake(spark, sf), catalog(spark, sf), GENERIC))


def _quality(name: str) -> Query:
    family, run = QUALITY_RUNS[name]

    def query(spark: SparkSession, sf: str) -> DataFrame:
        report = quality.validate_quality(normalize_drug_rows(raw_rows(family)(spark, sf), run), run)
        return _dates_as_text(report)

    return query


def _dates_as_text(frame: DataFrame) -> DataFrame:
    return frame.withColumns({c: F.col(f"`{c}`").cast("string") for c in DATES if c in frame.columns})


def normalize_ages(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalize_drug_rows(inputs.read_input(spark, sf, inputs.AGES), CampaignParams())
    return rows.select("row_no", F.col("age_min").cast("double"), "age_max")


def quality_issue_counts(spark: SparkSession, sf: str) -> DataFrame:
    family, run = QUALITY_RUNS["quality_vf"]
    return quality.issue_counts(normalize_drug_rows(raw_rows(family)(spark, sf), run), run)


def quality_issue_rows(spark: SparkSession, sf: str) -> DataFrame:
    family, run = QUALITY_RUNS["quality_fdro"]
    return quality.issues_per_row(normalize_drug_rows(raw_rows(family)(spark, sf), run), run, ["row_no"])


def _target_indicator(run: CampaignParams) -> Query:
    return lambda spark, sf: quality.validate_target_indicator(formulary(spark, sf), run)


def check_counts(spark: SparkSession, sf: str) -> DataFrame:
    run = CampaignParams(campaign_id=64, run_type="CF")
    drugs = validate_drugs(raw_rows("common")(spark, sf), run, formulary(spark, sf))
    codes = validate_intake(intake(spark, sf), catalog(spark, sf), run)
    return findings.check_counts(drugs.findings, codes.validity)


def _own(name: str) -> str:
    """A name for a table or schema of this call alone: results are read from it later."""
    return f"{name}_{uuid.uuid4().hex}"


def _stored_intake(spark: SparkSession, sf: str) -> IntakeResult:
    return validate_intake(intake(spark, sf), catalog(spark, sf), GENERIC, _own("drug_validity"), buckets=8)


def prune_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Contradictory matches deleted from a stored table, by level."""
    name, rows = _own("drug_validity"), _validity(GENERIC, pruned=False)(spark, sf)
    tables.replace_table(rows, name, partitions=["druglvl"])
    tables.delete_rows(spark, name, checks.contradicts(GENERIC), ["druglvl"])
    return tables.read_table(spark, name).select(rows.columns)


def _recorded(spark: SparkSession, sf: str) -> str:
    """The history table after a run was recorded twice beside another run."""
    schema = _own("history")
    spark.sql(f"CREATE SCHEMA {schema}")
    variables = inputs.read_input(spark, sf, inputs.RUN_VARIABLES)
    for key in ("run 1", "run 2", "run 1"):
        name = append_history(variables, LOAD, key, schema, logged_at=F.col("run_ts"))
    return name


def history_append(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.read_table(spark, _recorded(spark, sf))
    return rows.withColumn("dqi_ts", F.col("dqi_ts").cast("timestamp_ntz"))


def history_statistics(spark: SparkSession, sf: str) -> DataFrame:
    found = tables.read_statistics(spark, _recorded(spark, sf), align.ROW_ID)
    return spark.createDataFrame([found], "row_count long, distinct_count long, null_count long")


def schema_difference(spark: SparkSession, sf: str) -> DataFrame:
    return align.schema_difference(spark.read.parquet(f"{sf}/customer.parquet"), LOAD_TARGET)


def disposition_texts(spark: SparkSession, sf: str) -> DataFrame:
    return disposition.run_texts(_disposed(RUN)(spark, sf))


def raised_issues(spark: SparkSession, sf: str) -> DataFrame:
    return findings.raised_issues(check_counts(spark, sf), 7, CampaignParams(campaign_id=64))


def exclusions(spark: SparkSession, sf: str) -> DataFrame:
    return validate_intake(intake(spark, sf), catalog(spark, sf), GENERIC).exclusions_table


def duplicate_report_rows(spark: SparkSession, sf: str) -> DataFrame:
    found = validate_intake(intake(spark, sf), catalog(spark, sf), GENERIC)
    return campaign.report_rows(findings.DUPLICATES, found.duplicates, GENERIC)


def quality_report_rows(spark: SparkSession, sf: str) -> DataFrame:
    run = CampaignParams(campaign_id=557, program_type="MAPD")
    found = validate_drugs(raw_rows("gstp")(spark, sf), run)
    return campaign.report_rows(findings.QUALITY, found.faulty, run)


def first_failures(spark: SparkSession, sf: str) -> DataFrame:
    return findings.first_failures(check_counts(spark, sf))


def bulkload_align(spark: SparkSession, sf: str) -> DataFrame:
    aligned = align.align_to_target(spark.read.parquet(f"{sf}/customer.parquet"), LOAD_TARGET)
    return _as_compared(aligned)


def bulkload_clean(spark: SparkSession, sf: str) -> DataFrame:
    return align.strip_unprintable(spark.read.parquet(f"{sf}/documents.parquet"), LOAD)


def append_projection(spark: SparkSession, sf: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    target = spark.createDataFrame([], LOAD_TARGET)
    return _as_compared(prepare_load(customer, target, LOAD))


def _as_compared(frame: DataFrame) -> DataFrame:
    """Dates as text and times without a zone, which compare alike in every engine."""
    return frame.withColumns(
        {"opened": F.col("opened").cast("string"), "dqi_ts": F.col("dqi_ts").cast("timestamp_ntz")}
    )


def run_variable_history(spark: SparkSession, sf: str) -> DataFrame:
    variables = inputs.read_input(spark, sf, inputs.RUN_VARIABLES)
    rows = history_rows(variables, LOAD, logged_at=F.col("run_ts"))
    return rows.withColumn("dqi_ts", F.col("dqi_ts").cast("timestamp_ntz"))


def _disposed(run: CampaignParams) -> Query:
    return lambda spark, sf: disposition.dispose_issues(
        issues(spark, sf), messages(spark, sf), campaigns(spark, sf), run
    )


def disposition_runs(spark: SparkSession, sf: str) -> DataFrame:
    return disposition.run_flags(_disposed(RUN)(spark, sf))


def disposition_messages(spark: SparkSession, sf: str) -> DataFrame:
    return disposition.run_messages(_disposed(RUN)(spark, sf))


def message_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return disposition.message_pairs(inputs.read_input(spark, sf, inputs.TURN_MESSAGES))


def campaign_flags(spark: SparkSession, sf: str) -> DataFrame:
    return disposition.campaign_flags(inputs.read_input(spark, sf, inputs.CUSTOMER_FLAGS))


def drug_count(spark: SparkSession, sf: str) -> DataFrame:
    return summary.drug_counts(runs(spark, sf), formulary(spark, sf), intake(spark, sf))


def campaign_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return summary.campaign_names(runs(spark, sf), campaigns(spark, sf))


def campaign_summary(spark: SparkSession, sf: str) -> DataFrame:
    count = summary.drug_count(F.col("campaign_id"), formulary(spark, sf), intake(spark, sf))
    return summary.run_summaries(runs(spark, sf), campaigns(spark, sf), projects(spark, sf), count)


QUERIES: dict[str, Query] = {
    "scan_catalog": catalog,
    "scan_intake": intake,
    "normalize_defaults": _normalized(CampaignParams(), NORMALIZED_DEFAULTS),
    "normalize_ages": normalize_ages,
    "normalize_codes": _normalized(CampaignParams(), NORMALIZED_CODES),
    "normalize_limits_intake": _normalized(CampaignParams(campaign_id=24, context=p.INTAKE), NORMALIZED_LIMITS),
    "normalize_limits_standard": _normalized(CampaignParams(campaign_id=24), NORMALIZED_LIMITS),
    "normalize_limits_balance": _normalized(CampaignParams(campaign_id=67), NORMALIZED_LIMITS),
    "normalize_limits_none": _normalized(CampaignParams(campaign_id=20), NORMALIZED_LIMITS),
    "match_ndc11": _matched("NDC11"),
    "match_ndc9": _matched("NDC9"),
    "match_gpi": _matched("GPI"),
    "drug_validity": _validity(GENERIC, pruned=False),
    "drug_validity_mony": _validity(MONY, pruned=False),
    "prune_generic": _validity(GENERIC, pruned=True),
    "prune_mony": _validity(MONY, pruned=True),
    "dup_groups": lambda spark, sf: checks.duplicate_groups(_validity(GENERIC, pruned=True)(spark, sf)),
    "dup_report": _checked(checks.duplicate_report),
    "dup_rows_exact": _checked(checks.duplicate_rows),
    "inclusions": lambda spark, sf: checks.rows_of_type(_validity(GENERIC, pruned=True)(spark, sf), "I"),
    "invalid_exclusions": _checked(checks.invalid_exclusions),
    **{name: _quality(name) for name in QUALITY_RUNS},
    "quality_issue_counts": quality_issue_counts,
    "quality_issue_rows": quality_issue_rows,
    "target_indicator": _target_indicator(CampaignParams(campaign_id=561)),
    "target_indicator_cf": _target_indicator(CampaignParams(campaign_id=64, run_type="CF")),
    "check_counts": check_counts,
    "prune_stored": prune_stored,
    "dup_report_stored": lambda spark, sf: _stored_intake(spark, sf).duplicates,
    "exclusions_stored": lambda spark, sf: _stored_intake(spark, sf).exclusions,
    "history_append": history_append,
    "history_statistics": history_statistics,
    "schema_difference": schema_difference,
    "disposition_texts": disposition_texts,
    "raised_issues": raised_issues,
    "exclusions": exclusions,
    "duplicate_report_rows": duplicate_report_rows,
    "quality_report_rows": quality_report_rows,
    "first_failures": first_failures,
    "bulkload_align": bulkload_align,
    "bulkload_clean": bulkload_clean,
    "append_projection": append_projection,
    "run_variable_history": run_variable_history,
    "disposition_rows": _disposed(RUN),
    "disposition_rows_test_install": _disposed(TEST_RUN),
    "disposition_runs": disposition_runs,
    "disposition_messages": disposition_messages,
    "message_unpivot": message_unpivot,
    "campaign_flags": campaign_flags,
    "project_titles": lambda spark, sf: summary.project_titles(projects(spark, sf)),
    "project_clean": lambda spark, sf: summary.project_details(projects(spark, sf)),
    "campaign_lookup": campaign_lookup,
    "drug_count": drug_count,
    "campaign_summary": campaign_summary,
}
