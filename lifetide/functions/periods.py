"""Calendar buckets, as SQL expression text.

Weeks start on Sunday; Spark's own ``trunc(d, 'week')`` starts on Monday, so
the Sunday bucket is computed from ``dayofweek`` (1 = Sunday).  The ``*_sql``
builders return Spark SQL expression text over column names (or other
expression text); composing text and parsing it once in the JVM keeps plan
construction cheap.
"""

from __future__ import annotations

GRAINS = ("day", "week", "month")


def _check(grain: str) -> None:
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}; expected one of {GRAINS}")


def week_start_sql(d: str) -> str:
    """The Sunday on or before date ``d``."""
    return f"date_sub({d}, dayofweek({d}) - 1)"


def month_start_sql(d: str) -> str:
    """First day of the month of date ``d``."""
    return f"trunc({d}, 'MM')"


def period_start_sql(d: str, grain: str) -> str:
    _check(grain)
    return {"day": f"{d}", "week": week_start_sql(d), "month": month_start_sql(d)}[grain]


def next_period_sql(start: str, grain: str, n: int = 1) -> str:
    """Start of the period ``n`` periods after the one starting at ``start``."""
    _check(grain)
    return {"day": f"date_add({start}, {n})", "week": f"date_add({start}, {7 * n})",
            "month": f"add_months({start}, {n})"}[grain]


def period_offset_sql(later: str, earlier: str, grain: str) -> str:
    """Whole periods between two period starts, as BIGINT.

    Inputs are already period starts, so the week count is an exact division
    and the month count is calendar arithmetic (``timestampdiff(MONTH)``
    would count complete months instead, which only agrees on aligned dates).
    """
    _check(grain)
    body = {
        "day": f"datediff({later}, {earlier})",
        "week": f"datediff({later}, {earlier}) div 7",
        "month": f"(year({later}) - year({earlier})) * 12 + (month({later}) - month({earlier}))",
    }[grain]
    return f"CAST({body} AS BIGINT)"
