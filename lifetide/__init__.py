"""User-lifecycle analytics on Spark DataFrames.

Every public operator is a function ``DataFrame -> DataFrame`` built from the
public DataFrame / SQL API, so Catalyst plans it and the same code runs on a
laptop and on a cluster.  See README.md for the operator list.
"""

from lifetide.operators import (
    calendar,
    cohort_matrix,
    cohort_matrix_wide,
    dim_users,
    event_ordinal,
    fact_events,
    growth,
    growth_consolidated,
    status_report,
    transaction_breakdown,
    triangle,
    user_day_activity,
    user_day_runs,
    user_day_spine,
    user_day_status,
)
from lifetide.plans.pipeline import build_all
from lifetide.sources.events import (
    EVENT_COLUMNS,
    EVENT_SCHEMA,
    conform_events,
    from_events_table,
    from_orders_table,
    load_source,
    read_event_stream,
    read_event_table,
)
from lifetide.sinks import publish, read_published, view_sql, write_table

__all__ = [
    "EVENT_COLUMNS",
    "EVENT_SCHEMA",
    "build_all",
    "calendar",
    "cohort_matrix",
    "cohort_matrix_wide",
    "conform_events",
    "dim_users",
    "event_ordinal",
    "fact_events",
    "from_events_table",
    "from_orders_table",
    "growth",
    "growth_consolidated",
    "load_source",
    "publish",
    "read_event_stream",
    "read_event_table",
    "read_published",
    "status_report",
    "transaction_breakdown",
    "triangle",
    "user_day_activity",
    "user_day_runs",
    "user_day_spine",
    "user_day_status",
    "view_sql",
    "write_table",
]
