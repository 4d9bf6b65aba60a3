"""Build every model as stored tables, the way a scheduled job would.

``user_days`` (the per user-day measures with each user's neighbouring days)
is the one shared intermediate: it is written once, under the cluster's shared
checkpoint folder (``spark.checkpoint.dir``), as a table bucketed by user, and
read back.  That cuts the lineage to the raw events, the growth, spine, report
and retention models need no window over users of their own, and those that
roll days up to a user's weeks or months need no shuffle by user either.

A build is published as a whole (``lifetide.sinks``): all tables are written
below one new version folder, and one marker makes it the current one.  A
build that fails or is killed leaves the tables of before.  Models that are
cheap to recompute can stay views instead, computed when they are read: of the
session, or stored in the catalog as SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lifetide.functions.periods import month_start_sql, week_start_sql
from lifetide.operators import (
    calendar,
    cohort_matrix,
    cohort_matrix_wide,
    dim_users,
    event_ordinal,
    event_ordinal_ranges,
    expand_runs,
    fact_events,
    growth,
    run_status,
    status_report_of,
    transaction_breakdown,
    triangle,
    triangle_from_days,
    user_day_activity,
    user_day_runs,
    user_day_spine,
    user_day_status,
    user_days,
)
from lifetide.operators.activity import MEASURES
from lifetide.operators.growth import consolidated_rows
from lifetide.operators.status import STATUS_NAMES
from lifetide.session import checkpoint_dir
from lifetide.sinks.tables import delete, new_version, publish_folder, published_folder, write_table
from lifetide.sinks.views import create_view, view_sql

GROWTH_KEYS = {"day": ["cal_day", "cal_month"], "week": ["cal_week", "cal_month"], "month": ["cal_month"]}
GRAIN_NAME = {"day": "daily", "week": "weekly", "month": "monthly"}
#: Order of the stored tables whose models end in one.
SORT_KEYS = {
    "growth_transactions": ["user_id", "cal_day"],
    "growth_transactions_runs": ["user_id", "from_day"],
    "triangle_retention_daily": ["cohort_date", "period_offset"],
    "triangle_retention_weekly": ["cohort_week_date", "period_offset"],
    "triangle_retention_monthly": ["cohort_month_date", "period_offset"],
}
SPINES = ("days", "runs", None)


def stage_user_days(spark: SparkSession, events: DataFrame, table: str, path: str) -> DataFrame:
    """Store ``user_days`` of ``events`` as the catalog table ``table`` at
    ``path``, bucketed by user, and read it back.

    The rows come from one exchange by user with as many partitions as there
    are buckets, so a bucket is one file, and Spark knows from the catalog that
    a user's rows are together: aggregations and windows by user (and a user's
    periods) above it need no exchange.  A user has a row per active day, so no
    bucket follows one user's events."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    days = user_days(user_day_activity(events).repartition(buckets, "user_id"))
    days.write.format("parquet").bucketBy(buckets, "user_id").sortBy("user_id", "day").option("path", path).saveAsTable(table)
    return spark.table(table)


def build_all(
    spark: SparkSession,
    events: DataFrame,
    out_dir: str,
    fmt: str = "parquet",
    include_spine: bool = True,
    register_views: bool = False,
    lazy_views: bool = False,
    partition_by: dict[str, list[str]] | None = None,
    keep_stage: bool = False,
    spine: str | None = "days",
    sorted_tables: bool = False,
    event_table: str | None = None,
    catalog_prefix: str | None = None,
) -> dict[str, str]:
    """Write all models under ``out_dir`` (a shared location on a cluster) and
    publish them as one build.

    Returns {model name: path}; ``published_models`` finds the current build of
    an ``out_dir`` later.  ``spine="days"`` stores the gap-filled user x day
    tables (``growth_transactions`` and ``growth_accounting_frm_day``), whose
    size is users x active span; ``spine="runs"`` stores runs of days that are
    alike instead (``growth_transactions_runs`` and ``..._frm_day_runs``), of
    the size of the active days; ``include_spine=False`` or ``spine=None``
    skips them: the growth tables do not need them.  ``sorted_tables`` writes
    the models that end in an order (``SORT_KEYS``) in it.

    ``register_views`` also exposes every stored model as a temporary view of
    the same name.  ``lazy_views`` keeps the calendar, the user dimension, the
    event ordinals and the triangles as temporary views over ``events`` that
    are computed when read, never stale, instead of storing them.  With
    ``catalog_prefix`` views go to the catalog instead, under that prefix, so
    that other sessions read them: stored models as views of the current build
    (with runs expanded to days), the lazy ones as SQL over ``event_table``,
    the catalog table that ``events`` were read from.

    ``partition_by`` maps a model name to directory-partition columns (for
    example ``{"growth_transactions": ["cal_day"]}``) so readers can prune by
    period.  The staged intermediate is deleted when the build ends, also if a
    model fails, unless ``keep_stage``; a failed build deletes its own tables
    and leaves those of the build before.
    """
    if spine not in SPINES:
        raise ValueError(f"unknown spine {spine!r}; expected one of {SPINES}")
    if catalog_prefix is not None and lazy_views and event_table is None:
        raise ValueError("stored views of events need the catalog table that they read")
    out, version = out_dir.rstrip("/"), new_version()
    build = uuid.uuid4().hex
    stage, stage_table = f"{checkpoint_dir(spark).rstrip('/')}/lifetide-stage-{build}", f"lifetide_stage_{build}"
    paths: dict[str, str] = {}
    lazy: list[str] = []
    parts = partition_by or {}

    def save(name: str, df: DataFrame) -> None:
        path, order, then = f"{out}/{version}/{name}", SORT_KEYS.get(name) if sorted_tables else None, None
        if name == "growth_transactions" and order and name not in parts:
            # Runs of days are sorted instead of the days in them.
            df, order, then = user_day_runs(days), SORT_KEYS["growth_transactions_runs"], expand_runs
        write_table(df, path, fmt, parts.get(name), order, then)
        paths[name] = path

    def load(name: str) -> DataFrame:
        return spark.read.format(fmt).load(paths[name])

    def view(name: str, df: DataFrame, stored: DataFrame | None = None) -> None:
        """A model that may stay a view of ``df``; ``stored`` is a cheaper form to write."""
        if not lazy_views:
            save(name, df if stored is None else stored)
        elif catalog_prefix is not None:
            lazy.append(name)
        else:
            df.createOrReplaceTempView(name)

    try:
        # One aggregation of the raw events and one window by user, whose
        # partitioning the buckets keep.
        days = stage_user_days(spark, events, stage_table, f"{stage}/user_days")

        view("calendar", calendar(events), calendar(days, time_col="day"))
        view("dim_users", dim_users(events))
        save("fct_events", fact_events(events))
        view("event_ordinal", event_ordinal(events) if lazy_views else event_ordinal_ranges(events))

        if include_spine and spine == "days":
            save("growth_transactions", user_day_spine(days))
            save("growth_accounting_frm_day", user_day_status(load("growth_transactions")))
        elif include_spine and spine == "runs":
            save("growth_transactions_runs", user_day_runs(days))
            save("growth_accounting_frm_day_runs", run_status(load("growth_transactions_runs")))

        for grain, name in GRAIN_NAME.items():
            save(f"growth_accounting_{name}", growth(days, grain))
            if grain != "day":
                save(f"growth_accounting_{name}_strict", growth(days, grain, mode="strict"))
            save(f"status_report_{name}", status_report_of(load(f"growth_accounting_{name}"), GROWTH_KEYS[grain]))
            save(f"transaction_breakdown_{name}", transaction_breakdown(days, grain))
            view(f"triangle_retention_{name}", triangle(events, grain), triangle_from_days(days, grain))
            tri = triangle_from_days(days, grain) if lazy_views else load(f"triangle_retention_{name}")
            save(f"cohort_matrix_{name}", cohort_matrix(tri, grain))
            save(f"cohort_matrix_wide_{name}", cohort_matrix_wide(tri, grain))
        save("growth_accounting_consolidated", consolidated_rows(load("growth_accounting_daily")))
    except BaseException:
        delete(spark, f"{out}/{version}")
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {stage_table}")
        if not keep_stage:
            delete(spark, stage)
    publish_folder(spark, out, version)
    if register_views:
        for name in paths:
            load(name).createOrReplaceTempView(name)
    if catalog_prefix is not None:
        for name, path in paths.items():
            create_view(spark, f"{catalog_prefix}{name}", f"SELECT * FROM {fmt}.`{path}`")
        for name, select in EXPANDED.items():
            if f"{name}_runs" in paths:
                create_view(spark, f"{catalog_prefix}{name}", select.format(f"{catalog_prefix}{name}_runs"))
        for name in lazy:
            create_view(spark, f"{catalog_prefix}{name}", view_sql(name, event_table))
    return paths


def published_models(spark: SparkSession, out_dir: str) -> str:
    """Folder of the current build below ``out_dir``; models are its subfolders."""
    return published_folder(spark, out_dir)


_DAYS = "explode(sequence(from_day, to_day)) AS cal_day"
#: Models stored as runs -> SQL text of their rows by day.
EXPANDED = {
    "growth_transactions": f"SELECT user_id, {_DAYS}, trns_day, prev_day, is_new_user, first_seen, {', '.join(MEASURES)} FROM {{}}",
    "growth_accounting_frm_day": (
        f"SELECT user_id, {week_start_sql('cal_day')} AS cal_week, {month_start_sql('cal_day')} AS cal_month, cal_day, "
        f"trns_day, prev_day, {', '.join([*STATUS_NAMES, *MEASURES])} "
        f"FROM (SELECT *, {_DAYS} FROM {{}})"
    ),
}
