"""Stored tables that are published as a whole, and stored views."""

from lifetide.sinks.tables import (
    drop_unpublished,
    publish,
    publish_folder,
    published_folder,
    read_published,
    write_table,
)
from lifetide.sinks.views import VIEW_MODELS, create_view, create_views, view_sql

__all__ = [
    "VIEW_MODELS",
    "create_view",
    "create_views",
    "drop_unpublished",
    "publish",
    "publish_folder",
    "published_folder",
    "read_published",
    "view_sql",
    "write_table",
]
