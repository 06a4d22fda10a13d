"""Rules for ACF and ACSF intake files: mostly field widths."""

from __future__ import annotations

from rxsieve.functions.cells import longer_than, outside
from rxsieve.rules.base import Rule, alternative_text_required, exchange_rules

# Rule number, column, widest allowed text, name used in the message.
WIDTHS = [
    (25, "insulin calls", 12, "Insulin calls"),
    (26, "DRUG NAME", 100, "Drung Name"),
    (27, "PT_LTR", 30, "PT_LTR"),
    (28, "Add-back PT_LTR", 30, "Add_back_PT_LTR"),
    (29, "Insert", 30, "pt_Insert"),
    (30, "PT_LTR_RETAIL", 30, "PT_LTR_RETAIL"),
    (31, "Add-back_Retail", 30, "Add_back_Retail"),
    (32, "MD_LTR", 30, "MD_LTR"),
    (33, "VF_ACSF_PT_LTR", 30, "VF_ACSF_PT_LTR"),
    (34, "VF-ACSF_MD_LTR", 30, "VF_ACSF_MD_LTR"),
    (35, "Add-Back Merge Field", 300, "Add_Back_Merge_Field"),
    (36, "include or exclude", 1, "Include_or_Exclude"),
]


def acf_rules() -> list[Rule]:
    return [
        Rule(24, outside("GF", "Y", "N", "M", " "), "Invalid GrandFather Flag"),
        *(Rule(n, longer_than(column, limit), f"Invalid Length of {shown}") for n, column, limit, shown in WIDTHS),
        alternative_text_required(37),
        *exchange_rules(38),
    ]
