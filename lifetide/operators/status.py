"""Row-level statuses on the spine (growth_accounting_frm_day)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lifetide.functions.labels import day_flags_sql, status_labels
from lifetide.functions.periods import month_start_sql, week_start_sql
from lifetide.operators.activity import MEASURES


def status_columns(strict_subtype: bool = False) -> list[str]:
    """The five 1-or-NULL flags and the two labels, as SQL text over the
    columns of a spine row or of a run of days."""
    active, prev = "trns_day IS NOT NULL", "prev_day IS NOT NULL"
    flags = day_flags_sql("is_new_user", active, prev)
    labels = status_labels(f"NOT ({active}) AND {prev}", strict_subtype)
    return [f"{e} AS {n}" for n, e in {**flags, **labels}.items()]


STATUS_NAMES = ["new_user", "active", "retained", "resurrected", "churned", "trns_type", "trns_sub_type"]
_BUCKETS = [f"{week_start_sql('cal_day')} AS cal_week", f"{month_start_sql('cal_day')} AS cal_month"]


def user_day_status(spine: DataFrame, strict_subtype: bool = False) -> DataFrame:
    """Add week / month buckets, five 1-or-NULL status flags and the
    transaction type / sub-type labels to every spine row.  Pure
    projection: no shuffle."""
    return spine.selectExpr("user_id", *_BUCKETS, "cal_day", "trns_day", "prev_day", *status_columns(strict_subtype), *MEASURES)


def run_status(runs: DataFrame, strict_subtype: bool = False) -> DataFrame:
    """The same flags and labels on runs of days (``user_day_runs``): computed
    once a run instead of once a day."""
    return runs.selectExpr("user_id", "from_day", "to_day", "trns_day", "prev_day", *status_columns(strict_subtype), *MEASURES)


def expand_run_status(runs: DataFrame) -> DataFrame:
    """``user_day_status`` from ``run_status``, one row a day."""
    days = runs.selectExpr("user_id", "explode(sequence(from_day, to_day)) AS cal_day", "trns_day", "prev_day", *STATUS_NAMES, *MEASURES)
    return days.selectExpr("user_id", *_BUCKETS, "cal_day", "trns_day", "prev_day", *STATUS_NAMES, *MEASURES)
