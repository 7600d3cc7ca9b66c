"""Numbers and number ranges inside short texts, and the limits they must keep.

Expressions that run inside array functions are written as SQL text, which Spark parses in
one step; as nested Python lambdas each node would be a call into the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: pattern and limits -------------------------------------------------
_NUMBER = r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"
_UNIT = r"(?:\s*(?:[a-zA-ZµμΩ°%]+))?"
NUMBER_OR_RANGE = (
    rf"(?U)(?<![\w./])({_NUMBER}){_UNIT}"
    rf"(?:\s*(?:-|[–—])\s*({_NUMBER}){_UNIT})?(?![\w./])"
)
MAINS_VOLTS = 230.0
MAINS_VOLTS_MAX = 250.0
LOW_VOLTS = 100.0
LOW_AMPS = 5.0




def parse_range_sql(value: str) -> str:
    """SQL for ``named_struct(first, second)`` of the first number or range in ``value``:
    ``second`` is null for a single number, both are null without a number."""
    ends = ", ".join(
        f"'{name}', try_cast(regexp_extract({value}, r'{NUMBER_OR_RANGE}', {i}) AS double)"
        for i, name in ((1, "first"), (2, "second")))
    return f"named_struct({ends})"


def voltage_ok_sql(number: str, exact: str) -> str:
    """SQL for the mains voltage rule on a parsed number; without a number it holds.

    A single number counts as a range of one.
    """
    lo, hi = (f"{f}({number}.first, {number}.second)" for f in ("least", "greatest"))
    return (
        f"coalesce({hi} < {LOW_VOLTS}D OR if({exact},"
        f" {lo} <= {MAINS_VOLTS}D AND {hi} >= {MAINS_VOLTS}D,"
        f" {lo} >= {MAINS_VOLTS}D AND {hi} <= {MAINS_VOLTS_MAX}D), true)"
    )


def limit_ok_sql(number: str, limit: float, exact: str) -> str:
    """SQL for the upper limit rule on a parsed number; without a number it holds.

    With ``exact`` a single number must equal the limit or be low, and a range holds.
    """
    lo, hi = (f"{f}({number}.first, {number}.second)" for f in ("least", "greatest"))
    return (
        f"coalesce(if({exact}, {number}.second IS NOT NULL OR {lo} = {limit}D"
        f" OR {lo} <= {LOW_AMPS}D, {hi} <= {limit}D), true)"
    )


def parse_range(column: str) -> Column:
    """``struct(first, second)`` of a text column, see :func:`parse_range_sql`."""
    return F.expr(parse_range_sql(f"`{column}`"))


def voltage_ok(number: str, exact: str) -> Column:
    return F.expr(voltage_ok_sql(f"`{number}`", exact))


def limit_ok(number: str, limit: float, exact: str) -> Column:
    return F.expr(limit_ok_sql(f"`{number}`", limit, exact))
