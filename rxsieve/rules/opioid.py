"""Rules for opioid campaigns."""

from __future__ import annotations

from pyspark.sql import functions as F

from rxsieve.functions.cells import blank, cell, text
from rxsieve.rules.base import Rule


def opioid_rules() -> list[Rule]:
    dosed = F.upper(F.trim(text("alternative_text"))) != "EXCLUDE"
    # Messages.
    return [
        Rule(155, dosed & cell("opioid_daily_dose_limit").isNull(), "Invalid Daily Dose Limit"),
        Rule(156, dosed & blank("opioid_daily_dose_text"), "Missing Daily Dose Text"),
    ]
