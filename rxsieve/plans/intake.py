"""Drug intake: match, prune, duplicates, exclusions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rxsieve.operators import checks, match
from rxsieve.params import CampaignParams
from rxsieve.plans.findings import DUPLICATES, EXCLUSIONS, Check
from rxsieve.sources import tables


@dataclass(frozen=True)
class IntakeResult:
    validity: DataFrame
    duplicates: DataFrame
    exclusions: DataFrame
    # whether the checks are those of ``validity``, so that they may be made again from a copy of it
    derived: bool = False

    @property
    def inclusions_table(self) -> DataFrame:
        return checks.rows_of_type(self.validity, "I").orderBy("drug_id")

    @property
    def exclusions_table(self) -> DataFrame:
        return checks.rows_of_type(self.validity, "E").orderBy("drug_id")

    @property
    def findings(self) -> dict[Check, DataFrame]:
        return {DUPLICATES: self.duplicates, EXCLUSIONS: self.exclusions}


def pruned_validity(drugs: DataFrame, catalog: DataFrame, run: CampaignParams) -> DataFrame:
    """Matches without contradictions."""
    return checks.prune_matches(match.drug_validity(drugs, catalog, run), run)


def checked(validity: DataFrame, bucketed: bool = False) -> IntakeResult:
    """The checks of pruned matches; ``bucketed``: they lie in buckets of ``drug_id``."""
    report = checks.duplicate_report_by_product if bucketed else checks.duplicate_report
    return IntakeResult(validity, report(validity), checks.invalid_exclusions(validity), derived=True)


def validate_intake(drugs: DataFrame, catalog: DataFrame, run: CampaignParams, table: str | None = None, buckets: int = 0) -> IntakeResult:
    """The checks of the pruned matches.

    With ``table`` the matches are written to it, in place of an older one, and each check reads the table, which stays until ``discard_matches``. With
    ``buckets`` it lies in so many buckets of ``drug_id``, and no check shuffles it again; without, hot products are spread.
    Without a table everything is lazy and nothing is left behind.
    """
    validity = pruned_validity(drugs, catalog, run)
    if not table:
        return checked(validity)
    tables.replace_table(validity, table, ["drug_id"], buckets)
    return checked(tables.read_table(drugs.sparkSession, table), buckets > 0)


def discard_matches(spark: SparkSession, table: str) -> None:
    """Drop the matches that ``validate_intake`` wrote, if they are there."""
    tables.drop_table(spark, table)
