"""Triangle (cohort) retention by day, Sunday-week or month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lifetide.functions.periods import month_start_sql, period_offset_sql, period_start_sql

COHORT_COLUMN = {"day": "cohort_date", "week": "cohort_week_date", "month": "cohort_month_date"}


def user_periods(events: DataFrame, grain: str) -> DataFrame:
    """Distinct (user_id, period) pairs of known users; the period is NULL for
    events without a time.  Partially aggregated before the shuffle."""
    return (
        events.where("user_id IS NOT NULL")
        .selectExpr("user_id", f"{period_start_sql('to_date(event_time)', grain)} AS period")
        .distinct()
    )


def triangle(events: DataFrame, grain: str = "day") -> DataFrame:
    """Users of each first-period cohort active ``period_offset`` periods later.

    Columns: cal_month, cohort_ref_month, cohort_{date|week_date|month_date},
    period_offset, users, cohort_size, retention_rate (users / cohort_size,
    NULL on a zero size).

    Plan: distinct user-periods (one shuffle by user and period) -> cohort =
    min(period) over the user (a second one, by user; a user has at most one
    row per period) -> ``_triangle`` of the pairs.  The result is sparse (no
    row for an offset without returning users); a user with NULL-time events
    yields a NULL-offset row, and users with no timed event have no cohort
    and drop out.
    """
    up = user_periods(events, grain)
    return _triangle(up.select("period", F.min("period").over(Window.partitionBy("user_id")).alias("cohort")), grain)


def triangle_from_days(days: DataFrame, grain: str = "day") -> DataFrame:
    """The same from a stored ``user_days`` table, with no shuffle by user: a
    user's first row in a period is the one whose previous active day is
    missing or in an earlier period, and the cohort is the period of
    ``first_seen``.  Rows without a day stand for the user's untimed events."""
    period, before = period_start_sql("day", grain), period_start_sql("prev_active", grain)
    firsts = days.where("user_id IS NOT NULL").where(f"day IS NULL OR prev_active IS NULL OR {before} < {period}")
    return _triangle(firsts.selectExpr(f"{period} AS period", f"{period_start_sql('first_seen', grain)} AS cohort"), grain)


def _triangle(pairs: DataFrame, grain: str) -> DataFrame:
    """From one (period, cohort) row per user and period: counts per pair with
    partial aggregation; the cohort size is the offset-0 count, by a window
    over the small per-cohort table instead of a self-join."""
    counts = (
        pairs.where("cohort IS NOT NULL")
        .groupBy("cohort", "period")
        .agg(F.count(F.lit(1)).alias("users"))
        .withColumn("period_offset", F.expr(period_offset_sql("period", "cohort", grain)))
    )
    size = F.max(F.expr("CASE WHEN period_offset = 0 THEN users END")).over(Window.partitionBy("cohort"))
    out = counts.select("*", size.alias("cohort_size")).where("cohort_size IS NOT NULL")
    return out.selectExpr(
        f"{month_start_sql('period')} AS cal_month",
        f"{month_start_sql('cohort')} AS cohort_ref_month",
        f"cohort AS {COHORT_COLUMN[grain]}",
        "period_offset",
        "CAST(users AS BIGINT) AS users",
        "CAST(cohort_size AS BIGINT) AS cohort_size",
        "try_divide(CAST(users AS DOUBLE), CAST(cohort_size AS DOUBLE)) AS retention_rate",
    )
