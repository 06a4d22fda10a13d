"""Rules for every campaign: record type, indicators and drug codes.

Star positions are judged on the codes as entered (``gpi_raw``, ``ndc11_raw``),
because normalising turns stars into SQL wildcards.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rxsieve.functions.cells import any_of, blank, cell, filled, holds, longer_than, outside, size_of, text
from rxsieve.rules.base import EXCLUDED, INCLUDED, Rule, is_included


def _raw(column: str, columns: set[str]) -> str:
    return f"{column}_raw" if f"{column}_raw" in columns else column


def record_rules() -> list[Rule]:
    # Code lists and messages.
    return [
        Rule(1, outside("rec_type", INCLUDED, EXCLUDED), "Invalid rec type"),
        Rule(2, is_included() & outside("b_g", "B", "G", "A", "", fold_case=True), "Invalid B_G indicator"),
    ]


def tier_rules() -> list[Rule]:
    wrong = is_included() & outside("ms_ss", "M", "S", "A", "", fold_case=True)
    return [Rule(71, wrong, "Invalid MS_SS indicator")]


def not_tier_rules() -> list[Rule]:
    wrong = is_included() & outside("ms_ss", "MS", "SS", "A", "", fold_case=True)
    return [Rule(72, wrong, "Invalid MS_SS indicator")]


def code_rules(columns: set[str]) -> list[Rule]:
    gpi_raw, ndc11_raw = _raw("gpi", columns), _raw("ndc11", columns)
    not_wildcard = outside("sql_join", "WILDCARD")
    with_gpi = filled("gpi")
    star_at = cell("ast") if "ast" in columns else F.instr(text(gpi_raw), "*")
    listed = ("ndc9", "ndc11", "rec_type", "gpi", "b_g", "ms_ss", "age_min", "age_max")

    def exponent(column: str, letter: str) -> Column:
        """A code damaged by scientific notation, like 1.2E+10."""
        return holds(column, letter, ".")

    # Code lists, widths and messages.
    return [
        Rule(78, blank("gpi") & blank("ndc11") & blank("ndc9"), "GPI and NDC are blank"),
        Rule(86, holds("ndc9", "*"), "Invalid NDC9"),
        Rule(87, holds(ndc11_raw, "*") & not_wildcard, "Invalid NDC11"),
        Rule(88, holds("ndc9", "-"), "Invalid NDC9"),
        Rule(89, holds("ndc11", "-"), "Invalid NDC11"),
        Rule(90, any_of([holds(c, ",") for c in listed]), "Multiple values separated by comma in one cell"),
        Rule(91, filled("ndc9") & (size_of("ndc9") != 9), "Invalid NDC9 length"),
        Rule(92, filled("ndc11") & (size_of("ndc11") != 11) & not_wildcard, "Invalid NDC11 length"),
        Rule(93, with_gpi & outside("gpi_len", "2", "4", "6", "8", "10", "12", "14"), "Invalid GPI length"),
        Rule(94, with_gpi & longer_than("gpi", 14), "Invalid GPI length"),
        Rule(
            95,
            with_gpi
            & holds(gpi_raw, "*")
            & (F.coalesce(star_at, F.lit(0)) <= F.length(F.replace(text(gpi_raw), F.lit("*"), F.lit("")))),
            "Invalid GPI",
        ),
        Rule(96, with_gpi & F.startswith(text(gpi_raw), F.lit("*")), "Invalid GPI"),
        Rule(97, with_gpi & outside("b_g", "B", "G", "A"), "B_G must be specified with GPI"),
        Rule(98, with_gpi & outside("ms_ss", "SS", "MS", "A"), "MS_SS must be specified with GPI"),
        Rule(99, exponent("ndc9", "E"), "Invalid NDC9"),
        Rule(100, exponent("ndc11", "E"), "Invalid NDC11"),
        Rule(101, exponent("gpi", "E"), "Invalid GPI"),
        Rule(102, exponent("ndc9", "e"), "Invalid NDC9"),
        Rule(103, exponent("ndc11", "e"), "Invalid NDC11"),
        Rule(104, exponent("gpi", "e"), "Invalid GPI"),
    ]
