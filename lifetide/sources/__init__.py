"""Readers that turn raw tables into the logical ``event_stream`` schema."""

from lifetide.sources.events import (
    EVENT_COLUMNS,
    EVENT_SCHEMA,
    catalog_source,
    check_event_schema,
    conform_events,
    from_events_table,
    from_orders_table,
    load_source,
    read_event_stream,
    read_event_table,
)

__all__ = [
    "EVENT_COLUMNS",
    "EVENT_SCHEMA",
    "catalog_source",
    "check_event_schema",
    "conform_events",
    "from_events_table",
    "from_orders_table",
    "load_source",
    "read_event_stream",
    "read_event_table",
]
