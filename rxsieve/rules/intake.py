"""Rules for the general drug intake form."""

from __future__ import annotations

from pyspark.sql import functions as F

from rxsieve.functions.cells import filled, one_of, text
from rxsieve.rules.base import Rule

# One position of ``_exceedlmt`` per field, in this order.
LIMIT_FIELDS = [
    "retail_qty_limit",
    "retail_qty_unit",
    "retail_qty_time",
    "mail_qty_limit",
    "mail_qty_unit",
    "mail_qty_time",
]


def intake_rules() -> list[Rule]:
    codes_given = sum((filled(c).cast("int") for c in ("ndc11", "ndc9", "gpi")), F.lit(0))
    # Messages.
    return [
        Rule(79, codes_given > 1, "Only 1 of NDC11, NDC9 or GPI can be populated"),
        *(
            Rule(105, F.substring(text("_exceedlmt"), i, 1) == "1", f"{field.replace('_', ' ')} exceeds 200 char")
            for i, field in enumerate(LIMIT_FIELDS, start=1)
        ),
        Rule(106, one_of("_exceed_rlimit", "1"), "Combined retail quantity limit fields exceeds 200 char"),
        Rule(107, one_of("_exceed_mlimit", "1"), "Combined mail quantity limit fields exceeds 200 char"),
    ]
