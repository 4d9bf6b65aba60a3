"""DataFrame -> DataFrame operators, one per model, plus reports."""

from lifetide.operators.activity import active_days, expand_runs, user_day_activity, user_day_runs, user_day_spine, user_days
from lifetide.operators.base import calendar, dim_users, event_ordinal, event_ordinal_ranges, fact_events
from lifetide.operators.growth import consolidated_groups, growth, growth_consolidated
from lifetide.operators.reports import cohort_matrix, cohort_matrix_wide, status_report, status_report_of, transaction_breakdown
from lifetide.operators.retention import triangle, triangle_from_days, user_periods
from lifetide.operators.status import expand_run_status, run_status, user_day_status

__all__ = [
    "active_days",
    "calendar",
    "cohort_matrix",
    "cohort_matrix_wide",
    "consolidated_groups",
    "dim_users",
    "event_ordinal",
    "event_ordinal_ranges",
    "expand_run_status",
    "expand_runs",
    "fact_events",
    "growth",
    "growth_consolidated",
    "run_status",
    "status_report",
    "status_report_of",
    "transaction_breakdown",
    "triangle",
    "triangle_from_days",
    "user_day_activity",
    "user_day_runs",
    "user_day_spine",
    "user_day_status",
    "user_days",
    "user_periods",
]
