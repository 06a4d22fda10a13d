"""Rules for FDRO intake files."""

from __future__ import annotations

from rxsieve.functions.cells import blank, filled, outside
from rxsieve.rules.base import Rule, alternative_text_required, exchange_rules, required


def fdro_rules() -> list[Rule]:
    hyper = filled("PTHYPERSTELLENT") | filled("MDHYPERSTELLENT")
    add_back = filled("add_back_messaging")
    add_back_hyper = filled("add_back_messaging_hyper")
    # Code lists and messages.
    return [
        Rule(3, outside("GRDFTHR", "N", "Y", "M", " ", fold_case=True), "Invalid GRDFTHR"),
        Rule(4, outside("class", "OTHER", "MSB", "SPECIALTY", "STRIPS/KITS", fold_case=True), "Invalid Class Value"),
        required(5, "Lbl_Name", "Label Name cannot be blank"),
        required(6, "XDRUG_TEXT", "XDrug Text cannot be blank"),
        required(7, "DRUGMSG", "Drug Message cannot be blank"),
        required(8, "GSTP_ALTERNATIVE_TEXT", "GSTP Alternative Text cannot be blank"),
        required(9, "MDXSTELLENT", "MDXSTELLENT cannot be blank"),
        required(10, "MDPASTELLENT", "MDPASTELLENT cannot be blank"),
        required(11, "PTXSTELLENT", "PTXSTELLENT cannot be blank"),
        required(12, "PTPASTELLENT", "PTPASTELLENT cannot be blank"),
        Rule(13, hyper & blank("HYPER_ALTERNATIVE_TEXT"), "HYPER ALTERNATIVE TEXT cannot be blank"),
        Rule(14, hyper & blank("HYPER_GSTP_ALTERNATIVE_TEXT"), "HYPER GSTP ALTERNATIVE TEXT cannot be blank"),
        Rule(15, outside("INSULIN_CALL", "N", "Y"), "Invalid Insulin calls Value"),
        alternative_text_required(16),
        Rule(17, add_back & blank("PTXAddbkStellent"), "PTXAddbkStellent cannot be blank"),
        Rule(18, add_back & blank("PTPAAddbkStellent"), "PTPAAddbkStellent cannot be blank"),
        Rule(19, add_back_hyper & blank("PTHyperAddbk"), "PTHyperAddbk cannot be blank"),
        Rule(
            20,
            outside("add_back_merge_drug_hyper_ind", "Y", "N", " "),
            "Invalid Add Back Merge Drug Hyper indicator Value",
        ),
        *exchange_rules(21),
    ]
