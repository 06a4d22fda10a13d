"""Rules for BC intake files."""

from __future__ import annotations

from rxsieve.functions.cells import blank, filled, longer_than, one_of, outside, size_of
from rxsieve.rules.base import Rule, exchange_rules, missing_value, required


def bc_rules() -> list[Rule]:
    language, letter = "ADD BACK LANGUAGE", "ADD BACK MEMBER LETTER TEMPLATE"
    # Code lists, widths and messages.
    return [
        Rule(41, outside("PUE FLAG", "Y", "N", "M"), "Invalid PUE Flag"),
        Rule(42, outside("SPCLTY MANAGED", "Y", "N"), "Invalid Speciality Managed"),
        Rule(43, outside("CALL TYPE", "E", "S", "N", " "), "Invalid Call Type"),
        missing_value(44, "EFFECTIVE DATE", "Invalid Effective Date"),
        Rule(45, size_of("NDC") != 11, "Invalid NDC 11"),
        required(46, "DRUG LABEL NAME", "Invalid Drug Label Name"),
        Rule(47, longer_than("DRUG LABEL NAME", 100), "Invalid Length Drug Label Name"),
        required(48, "DRUG BRAND NAME", "Invalid Drug Brand Name"),
        Rule(49, longer_than("DRUG BRAND NAME", 100), "Invalid Length Of Drug Brand Name"),
        required(50, "DRUG ABBR NAME", "Invalid Drug Abbrevation Name"),
        Rule(51, longer_than("DRUG ABBR NAME", 100), "Invalid Length of Drug Abbrevation Name"),
        required(52, "ALTERNATIVES", "Invalid Alternative Text"),
        Rule(53, longer_than("ALTERNATIVES", 300), "Invalid Length of Alternative Text"),
        Rule(54, outside("ADD BACK", "Y", "N"), "Invalid Add Back"),
        Rule(55, longer_than(language, 300), "Invalid Length of Add Back Language"),
        Rule(56, outside("PRODUCT CODE", "SP-PDPD", "FE-MNPA", "FE-TS"), "Invalid Product Code"),
        required(57, "MEMBER LETTER TEMPLATE ID", "Invalid Member Letter Template Id"),
        Rule(58, longer_than("MEMBER LETTER TEMPLATE ID", 30), "Invalid Length of Member Letter Template Id"),
        Rule(
            59,
            longer_than("MEMBER LETTER INSERT TEMPLATE ID", 30),
            "Invalid Length of Member Letter Insert Template Id",
        ),
        Rule(60, longer_than(letter, 30), "Invalid Length of Add Back Member Letter Template"),
        Rule(
            61,
            longer_than("ADD BACK MEMBER LETTER INSERT TE", 30),
            "Invalid Length of Add Back Member Letter Insert Template",
        ),
        Rule(62, longer_than("MEMBER CALL TEMPLATE ID", 30), "Invalid Length of Member Call Template Id"),
        required(63, "PRESCRIBER LETTER TEMPLATE ID", "Invalid Prescriber Letter Template Id"),
        Rule(64, longer_than("PRESCRIBER LETTER TEMPLATE ID", 30), "Invalid Length of Prescriber Letter Template Id"),
        required(65, "GSTP ALTERNATIVES", "GSTP ALTERNATIVE TEXT Cannot be blank"),
        Rule(66, one_of("ADD BACK", "Y") & (blank(language) | blank(letter)), "Invalid Add Back Yes Message"),
        Rule(67, one_of("ADD BACK", "N") & (filled(language) | filled(letter)), "Invalid Add Back No Message"),
        *exchange_rules(68),
    ]
