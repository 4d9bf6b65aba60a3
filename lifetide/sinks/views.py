"""Stored views: models as SQL text over a catalog table.

A view of a DataFrame lives in one session only.  The models that are cheap to
recompute are therefore also given as plain SQL, so ``CREATE OR REPLACE VIEW``
stores them in the catalog and any session (or any client of the catalog)
reads them without this library.  Each statement has the plan of the operator
of the same model: no theta join, distinct user-periods before counting, and
windows bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from lifetide.functions.periods import month_start_sql, period_offset_sql, period_start_sql
from lifetide.operators.base import ORDINAL_CHUNK
from lifetide.operators.retention import COHORT_COLUMN


def calendar_view(events: str) -> str:
    return f"""
SELECT explode(sequence(lo, hi)) AS day
FROM (SELECT min(to_date(event_time)) AS lo, max(to_date(event_time)) AS hi FROM {events})"""


def dim_users_view(events: str) -> str:
    return f"""
SELECT user_id, event_time AS first_event_time, platform AS first_platform,
       utm_source AS first_utm_source, country AS first_country
FROM (
  SELECT *, rank() OVER (PARTITION BY user_id ORDER BY event_time) AS place
  FROM {events} WHERE user_id IS NOT NULL AND event_time IS NOT NULL)
WHERE place = 1"""


def fct_events_view(events: str) -> str:
    return f"SELECT event_time, user_id, event_type, transaction_category, miles_amount FROM {events}"


def event_ordinal_view(events: str) -> str:
    first = f"chunk * {ORDINAL_CHUNK} + 1"
    return f"""
WITH instants AS (
  SELECT coalesce(user_id, 0) AS u, user_id IS NULL AS no_user, event_time IS NULL AS no_time, event_time,
         coalesce(date_trunc('minute', event_time), TIMESTAMP_NTZ '1970-01-01 00:00:00') AS minute, n
  FROM (SELECT user_id, event_time, count(*) AS n FROM {events} GROUP BY user_id, event_time)),
counted AS (
  SELECT *, sum(n) OVER (PARTITION BY u, no_user, no_time, minute ORDER BY event_time) - n AS earlier,
         sum(n) OVER (PARTITION BY u, no_user, no_time, minute) AS total
  FROM instants),
bases AS (
  SELECT u, no_user, no_time, minute,
         sum(total) OVER (PARTITION BY u, no_user ORDER BY no_time DESC, minute) - total AS base
  FROM counted WHERE earlier + n = total),
runs AS (
  SELECT CASE WHEN NOT no_user THEN u END AS user_id, event_time, base + earlier AS from_number, n,
         explode(sequence(0L, (n - 1) DIV {ORDINAL_CHUNK})) AS chunk
  FROM counted JOIN bases USING (u, no_user, no_time, minute))
SELECT user_id, event_time, from_number + i AS session_number
FROM (
  SELECT user_id, event_time, from_number, explode(sequence({first}, least(n, {first} + {ORDINAL_CHUNK - 1}))) AS i
  FROM runs)"""


def triangle_view(events: str, grain: str) -> str:
    period = period_start_sql("to_date(event_time)", grain)
    return f"""
WITH user_periods AS (SELECT DISTINCT user_id, {period} AS period FROM {events} WHERE user_id IS NOT NULL),
pairs AS (SELECT period, min(period) OVER (PARTITION BY user_id) AS cohort FROM user_periods),
counts AS (SELECT cohort, period, count(*) AS users FROM pairs WHERE cohort IS NOT NULL GROUP BY cohort, period),
sized AS (
  SELECT *, {period_offset_sql("period", "cohort", grain)} AS period_offset,
         max(CASE WHEN period = cohort THEN users END) OVER (PARTITION BY cohort) AS cohort_size
  FROM counts)
SELECT {month_start_sql("period")} AS cal_month, {month_start_sql("cohort")} AS cohort_ref_month,
       cohort AS {COHORT_COLUMN[grain]}, period_offset, users, cohort_size,
       try_divide(CAST(users AS DOUBLE), CAST(cohort_size AS DOUBLE)) AS retention_rate
FROM sized WHERE cohort_size IS NOT NULL"""


#: View model -> SELECT text over the name of an event stream table.
VIEW_MODELS: dict[str, Callable[[str], str]] = {
    "calendar": calendar_view,
    "dim_users": dim_users_view,
    "fct_events": fct_events_view,
    "event_ordinal": event_ordinal_view,
    "triangle_retention_daily": lambda events: triangle_view(events, "day"),
    "triangle_retention_weekly": lambda events: triangle_view(events, "week"),
    "triangle_retention_monthly": lambda events: triangle_view(events, "month"),
}


def view_sql(model: str, events: str) -> str:
    """The model's SELECT over the catalog table or view ``events``, which has
    the columns of the event stream."""
    return VIEW_MODELS[model](events)


def create_view(spark: SparkSession, name: str, select: str) -> None:
    """Store ``select`` in the catalog as ``name``, replacing that view in one step."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")


def create_views(spark: SparkSession, events: str, prefix: str = "") -> dict[str, str]:
    """Store every view model over ``events``; returns {model: view name}."""
    names = {model: f"{prefix}{model}" for model in VIEW_MODELS}
    for model, name in names.items():
        create_view(spark, name, view_sql(model, events))
    return names
