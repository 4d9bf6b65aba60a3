"""Period buckets and the status / type labels, as Spark SQL expression text
(composable, parsed once in the JVM)."""

from lifetide.functions.labels import day_flags_sql, status_labels, trns_sub_type_sql, trns_type_sql
from lifetide.functions.periods import (
    GRAINS,
    month_start_sql,
    next_period_sql,
    period_offset_sql,
    period_start_sql,
    week_start_sql,
)

__all__ = [
    "GRAINS",
    "day_flags_sql",
    "month_start_sql",
    "next_period_sql",
    "period_offset_sql",
    "period_start_sql",
    "status_labels",
    "trns_sub_type_sql",
    "trns_type_sql",
    "week_start_sql",
]
