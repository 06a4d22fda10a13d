"""Evaluates the active rules and reports faulty rows.

All rules are plain columns of one projection, evaluated once per row. Removing
repeated rows is the single shuffle. It comes before the first aggregate: rows are
wide and mostly differ, so combining them where they are read would gather all
rows of a file in one task and save nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxsieve.functions.cells import blank, cell, one_of
from rxsieve.params import INTAKE, CampaignParams
from rxsieve.rules.gates import rules_for
from rxsieve.session import partitions

MESSAGE = "validation_msg"
SEPARATOR = "; "
ROW_HASH = "validation_row_hash"

# Campaigns with a target-indicator check, and the one that also checks tiers.
TARGET_INDICATOR_CAMPAIGNS = (64, 561)
TIER_RANGE_CAMPAIGN, TIER_RANGE_RUN_TYPE = 64, "CF"


def validate_quality(drugs: DataFrame, run: CampaignParams) -> DataFrame:
    """The quality report: distinct faulty rows with one message text each.

    Under the general intake form working columns (leading underscore) are left
    out of the report, after the rules have read them.
    """
    rules = rules_for(run, drugs.columns)
    messages = F.concat_ws(SEPARATOR, *[F.when(r.fires, r.message) for r in rules])
    kept = [cell(c) for c in drugs.columns if not (run.in_context(INTAKE) and c.startswith("_"))]
    judged = drugs.select(*kept, messages.alias(MESSAGE))
    # Exploding the one-element array keeps faulty rows only. A filter would do the same, but Spark
    # pushes it below the projection, repeating every rule in it.
    faulty = F.filter(F.array(MESSAGE), lambda given: given != "")
    report = judged.select(*kept, F.explode(faulty).alias(MESSAGE))
    # Rows are dealt by one hash that is a key of the aggregate too. Dealt by their columns they would be shuffled again, as Spark takes constant columns
    # out of the keys. A number of partitions is given, or Spark joins them by their packed size, a tenth of what they take in memory.
    dealt = report.withColumn(ROW_HASH, F.xxhash64(*[cell(c) for c in report.columns]))
    return dealt.repartition(partitions(drugs.sparkSession), ROW_HASH).distinct().drop(ROW_HASH)


def issues_per_row(drugs: DataFrame, run: CampaignParams, keys: list[str]) -> DataFrame:
    """One row per faulty row and message, with the position of the message."""
    return validate_quality(drugs, run).select(*keys, F.posexplode(_messages()).alias("position", "message"))


def issue_counts(drugs: DataFrame, run: CampaignParams) -> DataFrame:
    """How often each message was given."""
    messages = validate_quality(drugs, run).select(F.explode(_messages()).alias("message"))
    return messages.groupBy("message").agg(F.count("*").alias("n_issues"))


def _messages() -> Column:
    """No message holds the separator, so splitting at it gives them back."""
    return F.split(MESSAGE, SEPARATOR)


def validate_target_indicator(formulary: DataFrame, run: CampaignParams) -> DataFrame:
    """Formulary rows with an unknown target indicator, or a tier change without its tiers.

    The two faults exclude each other and come from one table, so their union is
    one filter over one scan.
    """
    if run.campaign_id not in TARGET_INDICATOR_CAMPAIGNS:
        return formulary.limit(0)
    # The indicators.
    fault = ~one_of("drug_tgt_ind", "N", "T", "E", fold_case=True)
    if run.campaign_id == TIER_RANGE_CAMPAIGN and run.run_type == TIER_RANGE_RUN_TYPE:
        changes_tier = one_of("drug_tgt_ind", "T", fold_case=True)
        fault = fault | (changes_tier & (blank("tier_from") | blank("tier_to")))
    return formulary.filter(fault).distinct()
