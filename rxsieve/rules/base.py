"""What a rule is, and the shapes several families share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column

from rxsieve.functions.cells import blank, cell, one_of, outside


@dataclass(frozen=True)
class Rule:
    """``fires`` is true on a faulty row; ``number`` orders the messages of a row."""

    number: int
    fires: Column
    message: str


INCLUDED = "I"
EXCLUDED = "E"


def is_included() -> Column:
    return one_of("rec_type", INCLUDED)


def exchange_rules(first: int) -> list[Rule]:
    """The three exchange flags, checked alike in many families; columns, codes and messages are fixed values."""
    return [
        Rule(first + i, outside(flag, "N", "Y"), f"Invalid {flag} Value")
        for i, flag in enumerate(("RXCHANGE_SPC", "RXCHANGE_MAIL", "RXCHANGE_RETAIL"))
    ]


def alternative_text_required(number: int, also: Column | None = None) -> Rule:
    # Fixed value: the message.
    missing = is_included() & blank("alternative_text")
    return Rule(number, missing if also is None else missing & also, "Alternative Messaging cannot be blank")


def required(number: int, column: str, message: str) -> Rule:
    return Rule(number, blank(column), message)


def missing_value(number: int, column: str, message: str) -> Rule:
    """For dates and numbers, where only NULL is missing."""
    return Rule(number, cell(column).isNull(), message)
