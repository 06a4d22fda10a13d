"""Rules for value-formulary intake files."""

from __future__ import annotations

from functools import reduce

from rxsieve.functions.cells import blank, cell, filled, longer_than, one_of, outside
from rxsieve.rules.base import Rule, exchange_rules, missing_value, required

# Allowed change types; the first group needs no alternative drug.
NO_ALTERNATIVE = ("PA", "QL", "DNT")
CHANGE_TYPES = ("FE", "FE-TS", "LC-CO", "LC-ED", "LC-FERT", "LC-HSDD", "LC-OB", "PA", "QL", "SP", "ST", "DNT")

# Letter columns, in message order (the sixth message names PBM too).
LETTERS = [
    (140, "MBR_LETTER_PBM", "MBR LETTER - PBM"),
    (141, "MBR_LETTER_INSERT_PBM", "MBR LETTER INSERT - PBM"),
    (142, "MBR_LETTER_PA_PBM", "MBR LETTER PA - PBM"),
    (143, "MBR_LETTER_BE_PBM", "MBR LETTER BE - PBM"),
    (144, "PRESCRIBER_LETTER_PBM", "PRESCRIBER LETTER - PBM"),
    (145, "MBR_LETTER_MDDB", "MBR LETTER - PBM"),
    (146, "MBR_LETTER_INSERT_MDDB", "MBR LETTER INSERT - MDDB"),
    (147, "MBR_LETTER_PA_MDDB", "MBR LETTER PA - MDDB"),
    (148, "MBR_LETTER_BE_MDDB", "MBR LETTER BE - MDDB"),
    (149, "PRESCRIBER_LETTER_MDDB", "PRESCRIBER LETTER - MDDB"),
]
MEMBER_LETTERS = [f"MBR_LETTER{kind}_{defn}" for defn in ("PBM", "MDDB") for kind in ("", "_PA", "_BE")]
PRESCRIBER_LETTERS = ["PRESCRIBER_LETTER_PBM", "PRESCRIBER_LETTER_MDDB"]


def _all_na(columns: list[str]):
    return reduce(lambda a, b: a & b, [one_of(c, "NA") for c in columns])


def value_formulary_rules() -> list[Rule]:
    quantity_limit = one_of("CHANGE_TYPE_PBM", "QL") | one_of("CHANGE_TYPE_MDDB", "QL")
    no_template = one_of("CALL_TEMPLATE", "NA", " ")
    # Code lists, widths and messages.
    return [
        Rule(108, outside("PUE_FLAG", "Y", "M", "N"), "Invalid PUE FLAG"),
        Rule(109, outside("SPECIALTY_MANAGED_PRODUCT", "Y", "N"), "Invalid SPECIALTY MANAGED PRODUCT"),
        Rule(110, outside("CALL_TYPE", "I", "N", "S", " "), "Invalid Call Type"),
        missing_value(111, "EFF_DATE", "Invalid EFF DATE"),
        Rule(112, longer_than("DRUG LABEL NAME", 100), "DRUG LABLE NAME exceeds 100 chars"),
        required(113, "DRUG LABEL NAME", "DRUG LABEL NAME cannot be blank"),
        Rule(114, longer_than("DRUG BRAND NAME", 50), "DRUG BRAND NAME exceeds 50 chars"),
        required(115, "DRUG BRAND NAME", "DRUG BRAND NAME cannot be blank"),
        Rule(116, longer_than("DRUG ABBR NAME", 50), "DRUG ABBR NAME exceeds 50 chars"),
        required(117, "DRUG ABBR NAME", "DRUG ABBR NAME cannot be blank"),
        Rule(
            118,
            outside("CHANGE_TYPE_PBM", *NO_ALTERNATIVE) & blank("PBM_ALTERNATIVE"),
            "PBM ALTERNATIVE cannot be blank",
        ),
        Rule(
            119,
            outside("CHANGE_TYPE_MDDB", *NO_ALTERNATIVE) & blank("MDDB_ALTERNATIVE"),
            "MDB ALTERNATIVE cannot be blank",
        ),
        Rule(
            120,
            filled("PBM_ADD_BACK_PRODUCT") & blank("PBM_ADD_BACK_TEMPLATE"),
            "PBM ADD BACK TEMPLATE must be populated for add back",
        ),
        Rule(
            121,
            blank("PBM_ADD_BACK_PRODUCT") & filled("PBM_ADD_BACK_TEMPLATE"),
            "PBM ADD BACK PRODUCT must be populated for add back",
        ),
        Rule(
            122,
            filled("MDDB_ADD_BACK_PRODUCT") & blank("MDDB_ADD_BACK_TEMPLATE"),
            "MDB ADD BACK TEMPLATE must be populated for add back",
        ),
        Rule(
            123,
            blank("MDDB_ADD_BACK_PRODUCT") & filled("MDDB_ADD_BACK_TEMPLATE"),
            "MDB ADD BACK PRODUCT must be populated for add back",
        ),
        Rule(124, outside("PBM_MONY_CODE", "M", "O", "N", "Y"), "Invalid PBM MONY CODE"),
        Rule(125, outside("MDDB_MONY_CODE", "M", "O", "N", "Y"), "Invalid MDDB MONY CODE"),
        required(126, "FORMULARY_DESCRIPTION_PBM", "1565 FORMULARY DESCRIPTION - PBM cannot be blank"),
        Rule(127, outside("CHANGE_TYPE_PBM", *CHANGE_TYPES), "Invalid 1565 CHANGE TYPE - PBM"),
        Rule(128, outside("FORMULARY_GROUP_PBM", "F", "NF"), "Invalid FORMULARY GROUP - PBM"),
        required(129, "FORMULARY_DESCRIPTION_MDDB", "1565 FORMULARY DESCRIPTION - MDDB cannot be blank"),
        Rule(130, outside("CHANGE_TYPE_MDDB", *CHANGE_TYPES), "Invalid 1565 CHANGE TYPE - MDDB"),
        Rule(131, outside("FORMULARY_GROUP_MDDB", "F", "NF"), "Invalid FORMULARY GROUP - MDDB"),
        Rule(
            132,
            quantity_limit & cell("retail_qty_limit").isNull(),
            "RETAIL QUANTITY LIMIT - QTY must be populated for QL",
        ),
        Rule(
            133,
            quantity_limit & cell("retail_qty_time").isNull(),
            "RETAIL QUANTITY LIMIT - DAYS must be populated for QL",
        ),
        Rule(134, quantity_limit & blank("retail_qty_unit"), "RETAIL QUANTITY LIMIT - UNITS must be populated for QL"),
        Rule(135, quantity_limit & cell("mail_qty_limit").isNull(), "MAIL QUANTITY LIMIT - QTY must be populated for QL"),
        Rule(136, quantity_limit & cell("mail_qty_time").isNull(), "MAIL QUANTITY LIMIT - DAYS must be populated for QL"),
        Rule(137, quantity_limit & blank("mail_qty_unit"), "MAIL QUANTITY LIMIT - UNITS must be populated for QL"),
        Rule(138, one_of("CALL_TYPE", "I", "S") & no_template, "CALL TEMPLATE must be populated for Call Types"),
        Rule(139, one_of("CALL_TYPE", "N", " ") & ~no_template, "Call type invalid for populated CALL TEMPLATE"),
        *(required(n, column, f"{shown} cannot be blank") for n, column, shown in LETTERS),
        Rule(150, _all_na(MEMBER_LETTERS), "All Member letter templates cannot be NA"),
        Rule(151, _all_na(PRESCRIBER_LETTERS), "All Prescriber letter templates cannot be NA"),
        *exchange_rules(152),
    ]
