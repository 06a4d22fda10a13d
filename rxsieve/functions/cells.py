"""Column predicates and text clean-up shared by the operators.

NULL, the empty string and any run of blanks are one and the same missing
value. Every predicate here is true or false, never NULL, so it may be negated
and combined freely.

Predicates take a plain column name and are written as SQL expressions: a run
builds hundreds of them, and one expression is one call into the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name for SQL; names may hold blanks and hyphens."""
    return "`" + name.replace("`", "``") + "`"


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _text(name: str) -> str:
    return f"coalesce(cast({quoted(name)} as string), '')"


def cell(name: str) -> Column:
    return F.col(quoted(name))


def text(name: str) -> Column:
    """The cell as text, missing as the empty string."""
    return F.expr(_text(name))


def blank(name: str) -> Column:
    return F.expr(f"trim({_text(name)}) = ''")


def filled(name: str) -> Column:
    return F.expr(f"trim({_text(name)}) != ''")


def _one_of(name: str, values: tuple[str, ...], fold_case: bool) -> str:
    named = [_literal(v) for v in values if v.strip()]
    found = f"{f'upper({_text(name)})' if fold_case else _text(name)} in ({', '.join(named)})"
    return f"({found} or trim({_text(name)}) = '')" if len(named) < len(values) else found


def one_of(name: str, *values: str, fold_case: bool = False) -> Column:
    """The cell holds one of ``values``; a blank among them admits every missing spelling."""
    return F.expr(_one_of(name, values, fold_case))


def outside(name: str, *values: str, fold_case: bool = False) -> Column:
    return F.expr(f"not {_one_of(name, values, fold_case)}")


def size_of(name: str) -> Column:
    return F.expr(f"length({_text(name)})")


def longer_than(name: str, limit: int) -> Column:
    return F.expr(f"length({_text(name)}) > {limit}")


def holds(name: str, *parts: str) -> Column:
    """The cell contains every one of ``parts``."""
    return F.expr(" and ".join(f"contains({_text(name)}, {_literal(part)})" for part in parts))


def any_of(conditions: list[Column]) -> Column:
    """Disjunction as a balanced tree: wide rule sets stay shallow for the optimizer."""
    if not conditions:
        return F.lit(False)
    while len(conditions) > 1:
        pairs = [conditions[i : i + 2] for i in range(0, len(conditions), 2)]
        conditions = [p[0] | p[1] if len(p) == 2 else p[0] for p in pairs]
    return conditions[0]


def surely(condition: Column) -> Column:
    """SQL's DELETE condition: an unknown outcome does not count."""
    return F.coalesce(condition, F.lit(False))


def sql_wildcards(c: str | Column) -> Column:
    return F.translate(c, "?*", "_%")


def clean_title(c: str | Column) -> Column:
    """Project titles lose quotes, commas and ampersands."""
    return F.trim(F.regexp_replace(c, "['\",&]", ""))


def clean_code(c: str | Column) -> Column:
    """Product codes: anything but letters and digits becomes a blank."""
    return F.trim(F.regexp_replace(c, "[^0-9A-Za-z]", " "))


def printable(c: str | Column) -> Column:
    return F.regexp_replace(c, "[^\\x20-\\x7E]", "")
