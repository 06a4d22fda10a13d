"""Drug quality: normalise raw rows, apply the rules, check target indicators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from rxsieve.operators.normalize import normalize_drug_rows
from rxsieve.operators.quality import validate_quality, validate_target_indicator
from rxsieve.params import CampaignParams
from rxsieve.plans.findings import QUALITY, TARGET_INDICATOR, Check


@dataclass(frozen=True)
class QualityResult:
    faulty: DataFrame
    target_indicator: DataFrame | None

    @property
    def findings(self) -> dict[Check, DataFrame]:
        found = {QUALITY: self.faulty}
        if self.target_indicator is not None:
            found[TARGET_INDICATOR] = self.target_indicator
        return found


def validate_drugs(raw: DataFrame, run: CampaignParams, formulary: DataFrame | None = None) -> QualityResult:
    """Quality report of raw drug rows, and of the formulary when one is given."""
    faulty = validate_quality(normalize_drug_rows(raw, run), run)
    return QualityResult(faulty, None if formulary is None else validate_target_indicator(formulary, run))
