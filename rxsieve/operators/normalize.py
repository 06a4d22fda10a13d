"""Normalises raw drug rows: defaults, wildcards, code level and quantity limits.

One narrow projection; no shuffle and no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxsieve.functions.cells import blank, cell, filled, holds, sql_wildcards, text
from rxsieve.params import INTAKE, CampaignParams

INPUT_COLUMNS = [
    "age_min", "age_max", "gpi", "ndc11", "ndc9", "b_g", "ms_ss", "drug_category", "retail_qty_limit",
    "retail_qty_unit", "retail_qty_time", "mail_qty_limit", "mail_qty_unit", "mail_qty_time",
]

# Defaults, widest combined limit text, and campaigns with their own limit logic.
DEFAULT_AGE_MIN = 0
DEFAULT_AGE_MAX = 999
DEFAULT_INDICATOR = "A"
WIDEST_LIMIT = 200
PLAIN_LIMIT_CAMPAIGNS = (67, 68, 554)
NO_LIMIT_CAMPAIGNS = (66,)
NO_LIMIT_UNLESS_CLIENT_SPECIFIC = (20, 558)
NO_LIMIT = " "


def normalize_drug_rows(drugs: DataFrame, run: CampaignParams) -> DataFrame:
    """Adds the derived columns; codes as entered stay in ``gpi_raw`` and ``ndc11_raw``.

    Keeping the raw codes and the star position lets the quality rules judge
    stars, which the wildcard conversion removes from ``gpi`` and ``ndc11``.
    An input column that is absent counts as empty and is added as such.
    """
    present = {f.name.lower(): f.dataType for f in drugs.schema.fields}
    absent = [c for c in INPUT_COLUMNS if c not in present]
    rows = drugs.withColumns({c: F.lit(None).cast("int" if c.startswith("age") else "string") for c in absent})

    gpi = F.trim(text("gpi"))
    stem = F.when(F.instr(gpi, "*") > 1, F.substring_index(gpi, "*", 1)).otherwise(gpi)
    drug_sub = sql_wildcards(stem)
    wildcard = (filled("ndc11") & _has_wildcard("ndc11")) | (
        blank("ndc11") & blank("ndc9") & filled("gpi") & _has_wildcard("gpi")
    )

    def by_level(ndc11: Column, ndc9: Column, gpi_code: Column) -> Column:
        return F.when(filled("ndc11"), ndc11).when(filled("ndc9"), ndc9).when(filled("gpi"), gpi_code)

    def indicator(name: str) -> Column:
        replace = blank(name) & blank("gpi") if run.in_context(INTAKE) else blank(name)
        return F.when(replace, F.lit(DEFAULT_INDICATOR)).otherwise(cell(name))

    def age(name: str, default: int) -> Column:
        standard = F.lit(default).cast(present.get(name, "int"))
        # by value, whatever the type: 0, 0.0 and '0.00' are no age
        return F.when(blank(name) | (cell(name).try_cast("double") == 0), standard).otherwise(cell(name))

    return rows.withColumns(
        {
            "gpi": sql_wildcards("gpi"),
            "ndc11": sql_wildcards("ndc11"),
            "gpi_raw": cell("gpi"),
            "ndc11_raw": cell("ndc11"),
            "ast": F.instr(gpi, "*"),
            "age_min": age("age_min", DEFAULT_AGE_MIN),
            "age_max": age("age_max", DEFAULT_AGE_MAX),
            "gpi_len": F.length(stem),
            "drug_sub": drug_sub,
            "b_g": indicator("b_g"),
            "ms_ss": indicator("ms_ss"),
            "druglvl": by_level(F.lit("NDC11"), F.lit("NDC9"), F.lit("GPI")),
            "drug_code": by_level(sql_wildcards("ndc11"), cell("ndc9"), drug_sub),
            "sql_join": F.when(wildcard, "WILDCARD").otherwise(""),
            "drugcat": F.trim(text("drug_category")),
            **_limits("retail", "rlimit", run),
            **_limits("mail", "mlimit", run),
        }
    )


def _has_wildcard(name: str) -> Column:
    """A wildcard as entered, or already in SQL spelling."""
    return holds(name, "?") | holds(name, "*") | holds(name, "_") | holds(name, "%")


def _limits(channel: str, out: str, run: CampaignParams) -> dict[str, Column]:
    """Limit text and overflow flag of one channel, chosen by campaign and context."""
    limit, unit, time = (f"{channel}_qty_{part}" for part in ("limit", "unit", "time"))
    any_given = filled(limit) | filled(unit) | filled(time)
    overflow = f"_exceed_{out}"
    within = F.lit(0)

    if run.campaign_id in PLAIN_LIMIT_CAMPAIGNS:
        return {overflow: within, out: F.when(any_given, F.trim(text(limit))).otherwise(NO_LIMIT)}

    phrase = F.concat(
        F.trim(text(limit)), F.lit(" "), F.trim(text(unit)), F.lit("/"), F.trim(text(time)), F.lit(" days")
    )
    combined = F.when(any_given, phrase).otherwise(NO_LIMIT)
    if run.in_context(INTAKE):
        cut = F.substring(combined, 1, WIDEST_LIMIT)
        return {overflow: (F.length(combined) > WIDEST_LIMIT).cast("int"), out: _usable(cut)}

    exempt = run.campaign_id in NO_LIMIT_CAMPAIGNS or (
        run.campaign_id in NO_LIMIT_UNLESS_CLIENT_SPECIFIC and run.client_specific == "N"
    )
    return {overflow: within, out: F.lit(None).cast("string") if exempt else _usable(combined)}


def _usable(limit: Column) -> Column:
    """A limit without a quantity, written ``./``, is no limit."""
    return F.when(F.startswith(F.trim(limit), F.lit("./")), NO_LIMIT).otherwise(limit)
