"""Scalar rules shared by all metrics, as Spark SQL expressions.

Each helper takes and returns expression text, so a metric reads as the SQL a
user would write and reaches Spark as one expression.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta


def literal(value: str | date) -> str:
    if isinstance(value, date):
        return f"DATE'{value.isoformat()}'"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def one_of(value: str, options: Iterable) -> str:
    items = ", ".join(literal(o) if isinstance(o, (str, date)) else str(o) for o in options)
    return f"{value} IN ({items})"


def is_text(value: str, *texts: str) -> str:
    """Equality that ignores case and trailing blanks, as business databases do."""
    return one_of(f"lower(rtrim({value}))", [t.lower().rstrip() for t in texts])


def zero_if_null(value: str) -> str:
    return f"coalesce({value}, 0)"


def ratio(numerator: str, denominator: str, digits: int) -> str:
    """Rounded quotient in DOUBLE; null when the denominator is zero or null."""
    return (
        f"round(CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0D), {digits})"
    )


def minutes_crossed(start: str, end: str) -> str:
    """Minute boundaries between two timestamps, so 08:00:59 to 08:01:01 counts 1.

    Counted on the clock face, so the session time zone has no say in it.
    """
    return (
        f"datediff({end}, {start}) * 1440 + (hour({end}) - hour({start})) * 60"
        f" + minute({end}) - minute({start})"
    )


def week_start(day: str) -> str:
    """The Monday on or before a date or timestamp."""
    return f"trunc(CAST({day} AS DATE), 'WEEK')"


def latest_boundary(day: str, boundaries: list[date]) -> str:
    """The last boundary on or before `day`.

    Windows that open and close on the boundaries hold for a day exactly when
    they hold for its boundary, so rows can be grouped by the result before
    any window is tested.  Days before all boundaries share one earlier label.
    """
    opened = [boundaries[0] - timedelta(days=1), *boundaries[:-1]]
    branches = " ".join(
        f"WHEN {day} < {literal(closed)} THEN {literal(label)}"
        for label, closed in zip(opened, boundaries)
    )
    last = literal(boundaries[-1])
    return f"CASE {branches} WHEN {day} >= {last} THEN {last} END"
