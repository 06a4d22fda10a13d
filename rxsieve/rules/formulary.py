"""Rules for exchange, step-therapy, balance-formulary and drug-message campaigns."""

from __future__ import annotations

from rxsieve.functions.cells import filled, longer_than, one_of, outside
from rxsieve.rules.base import Rule, alternative_text_required, exchange_rules


def health_exchange_rules() -> list[Rule]:
    return exchange_rules(73)


def step_therapy_rules() -> list[Rule]:
    return [alternative_text_required(76)]


def balance_rules() -> list[Rule]:
    return [alternative_text_required(77, also=one_of("change_type", "EX", "ST"))]


def grandfather_rules() -> list[Rule]:
    # Code list and message.
    return [
        Rule(80, filled("gf") & outside("gf", "N", "Y", "M", fold_case=True), "Invalid GF"),
        *exchange_rules(81),
    ]


def drug_message_rules(number: int, columns: set[str]) -> list[Rule]:
    """Up to twelve optional message columns; absent ones are not checked. Names and message are fixed values."""
    names = [f"DrugMsg_IB{i}" for i in range(1, 13)]
    return [Rule(number, longer_than(c, 300), f"Invalid Length of {c}") for c in names if c.lower() in columns]
