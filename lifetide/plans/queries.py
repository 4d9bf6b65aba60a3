"""Registry of the runnable queries: Spark plan + independent DuckDB SQL.

Each entry reads the whole source table at ``sf_dir`` through an adapter
(``events``: dense month; ``orders``: sparse 6.6 years with ties), runs one
operator and returns the result DataFrame.  Keys with the ``_orders`` suffix
run the same operator on the orders adapter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifetide.operators import (
    calendar,
    cohort_matrix,
    cohort_matrix_wide,
    dim_users,
    event_ordinal_ranges,
    expand_run_status,
    expand_runs,
    fact_events,
    growth,
    growth_consolidated,
    run_status,
    status_report,
    transaction_breakdown,
    triangle,
    user_day_activity,
    user_day_runs,
    user_day_spine,
    user_day_status,
)
from lifetide.plans import oracle
from lifetide.session import checkpoint_dir
from lifetide.sinks import create_view, publish, read_published, view_sql, write_table
from lifetide.sources.events import catalog_source, load_source, read_event_stream, read_event_table

QueryFn = Callable[[SparkSession, str], DataFrame]
GRAIN_NAME = {"day": "daily", "week": "weekly", "month": "monthly"}
#: Keys under which report tables were registered before every grain was.
EARLIER_NAMES = {
    "cohort_matrix": "cohort_matrix_daily",
    "cohort_matrix_orders": "cohort_matrix_monthly_orders",
    "status_report": "status_report_daily",
    "status_report_orders": "status_report_weekly_orders",
    "transaction_breakdown": "transaction_breakdown_daily",
    "transaction_breakdown_orders": "transaction_breakdown_monthly_orders",
}


@dataclass(frozen=True)
class Query:
    run: QueryFn
    sql: str | None


def _on(source: str, op: Callable[[DataFrame], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(load_source(spark, sf_dir, source))

    return run


def _folder(spark: SparkSession, name: str) -> str:
    """The folder of one query's stored table in the cluster's shared folder:
    the same in every run of the application, so that a run replaces the files
    of the one before."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lifetide-query-{spark.sparkContext.applicationId}/{name}"


def _reread(source: str, fmt: str) -> QueryFn:
    """The event stream written as text and read by ``read_event_stream``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _folder(spark, f"event_stream_{fmt}_{source}")
        text = load_source(spark, sf_dir, source).write.mode("overwrite").format(fmt)
        text.options(header="true", timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS").save(path)
        back = read_event_stream(spark, path, fmt)
        return back.withColumn("miles_amount", F.col("miles_amount").cast("bigint"))

    return run


def _from_catalog(source: str) -> QueryFn:
    """The event stream by its name in the session catalog."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read_event_table(spark, catalog_source(spark, sf_dir, source))

    return run


def _published(
    name: str,
    source: str,
    op: Callable[[DataFrame], DataFrame],
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> QueryFn:
    """A model published as a table (partitioned, or sorted) and read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _folder(spark, f"{name}_{source}")
        publish(op(user_day_activity(load_source(spark, sf_dir, source))), path, "parquet", partition_by, sort_by, then=then)
        return read_published(spark, path)

    return run


def _stored_runs(name: str, source: str, op: Callable[[DataFrame], DataFrame], expand: Callable[[DataFrame], DataFrame]) -> QueryFn:
    """Runs of days as a stored table, expanded to days when it is read."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _folder(spark, f"{name}_{source}")
        write_table(op(user_day_runs(user_day_activity(load_source(spark, sf_dir, source)))), path)
        # The files are small for the days in them, so the runs are dealt out to as many tasks as a shuffle has.
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return expand(spark.read.parquet(path).repartition(tasks, "user_id", "from_day"))

    return run


def _view_sink(source: str) -> QueryFn:
    """Weekly retention as a view that is computed when it is read."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        name = f"triangle_retention_weekly_{source}"
        triangle(load_source(spark, sf_dir, source), "week").createOrReplaceTempView(name)
        found = spark.table(name)
        spark.catalog.dropTempView(name)
        return found

    return run


def _stored_view(source: str, model: str) -> QueryFn:
    """A model as SQL stored in the catalog over a catalog table, read by its
    name in another session."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = catalog_source(spark, sf_dir, source)
        name = f"{events}_{model}"
        create_view(spark, name, view_sql(model, events))
        return spark.table(name)

    return run


def _wide(grain: str) -> Callable[[DataFrame], DataFrame]:
    """The wide cohort matrix with its arrays as text: users, and retention in
    whole millionths (an empty place where nobody returned)."""

    def op(events: DataFrame) -> DataFrame:
        wide = cohort_matrix_wide(triangle(events, grain), grain)
        shares = "transform(retention_rates, r -> coalesce(CAST(CAST(floor(r * 1000000) AS BIGINT) AS STRING), ''))"
        return wide.withColumns({
            "users": F.expr("array_join(transform(users, u -> CAST(u AS STRING)), ',')"),
            "retention_rates": F.expr(f"array_join({shares}, ',')"),
        })

    return op


def _build() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for source in ("events", "orders"):
        sfx = "" if source == "events" else "_orders"
        q[f"events_calendar{sfx}"] = Query(_on(source, calendar), oracle.calendar_sql(source))
        q[f"dim_users{sfx}"] = Query(_on(source, dim_users), oracle.dim_users_sql(source))
        q[f"fct_events{sfx}"] = Query(_on(source, fact_events), oracle.fct_events_sql(source))
        q[f"event_ordinal{sfx}"] = Query(_on(source, event_ordinal_ranges), oracle.event_ordinal_sql(source))
        q[f"user_day_activity{sfx}"] = Query(_on(source, user_day_activity), oracle.user_day_activity_sql(source))
        q[f"growth_daily{sfx}"] = Query(
            _on(source, lambda ev: growth(user_day_activity(ev), "day")), oracle.growth_daily_sql(source)
        )
        for grain in ("week", "month"):
            name = GRAIN_NAME[grain]
            q[f"growth_{name}{sfx}"] = Query(
                _on(source, lambda ev, g=grain: growth(user_day_activity(ev), g)),
                oracle.growth_period_sql(source, grain),
            )
            q[f"growth_{name}_strict{sfx}"] = Query(
                _on(source, lambda ev, g=grain: growth(user_day_activity(ev), g, mode="strict")),
                oracle.growth_period_sql(source, grain, strict=True),
            )
        q[f"growth_consolidated{sfx}"] = Query(
            _on(source, lambda ev: growth_consolidated(user_day_activity(ev))), oracle.growth_consolidated_sql(source)
        )
        for grain in ("day", "week", "month"):
            q[f"triangle_{GRAIN_NAME[grain]}{sfx}"] = Query(
                _on(source, lambda ev, g=grain: triangle(ev, g)), oracle.triangle_sql(source, grain)
            )
        q[f"user_day_spine{sfx}"] = Query(
            _on(source, lambda ev: user_day_spine(user_day_activity(ev))), oracle.user_day_spine_sql(source)
        )
        q[f"user_day_status{sfx}"] = Query(
            _on(source, lambda ev: user_day_status(user_day_spine(user_day_activity(ev)))),
            oracle.user_day_status_sql(source),
        )
        # Dashboard tables, every grain.
        for grain, name in GRAIN_NAME.items():
            q[f"cohort_matrix_{name}{sfx}"] = Query(
                _on(source, lambda ev, g=grain: cohort_matrix(triangle(ev, g), g)), oracle.cohort_matrix_sql(source, grain)
            )
            q[f"cohort_matrix_wide_{name}{sfx}"] = Query(_on(source, _wide(grain)), oracle.cohort_matrix_wide_sql(source, grain))
            q[f"status_report_{name}{sfx}"] = Query(
                _on(source, lambda ev, g=grain: status_report(user_day_activity(ev), g)), oracle.status_report_sql(source, grain)
            )
            q[f"transaction_breakdown_{name}{sfx}"] = Query(
                _on(source, lambda ev, g=grain: transaction_breakdown(user_day_activity(ev), g)),
                oracle.transaction_breakdown_sql(source, grain),
            )
        # The reader and the sinks, each against the model that went through it.
        for fmt in ("csv", "json"):
            q[f"event_stream_{fmt}{sfx}"] = Query(_reread(source, fmt), oracle.event_stream_sql(source))
        q[f"event_stream_table{sfx}"] = Query(_from_catalog(source), oracle.event_stream_sql(source))
        q[f"table_sink{sfx}"] = Query(
            _published("table_sink", source, lambda act: growth(act, "day"), partition_by=["cal_month"]), oracle.growth_daily_sql(source)
        )
        q[f"sorted_sink{sfx}"] = Query(
            _published("sorted_sink", source, user_day_runs, sort_by=["user_id", "from_day"], then=expand_runs),
            oracle.user_day_spine_sql(source),
        )
        q[f"spine_runs{sfx}"] = Query(_stored_runs("spine_runs", source, lambda r: r, expand_runs), oracle.user_day_spine_sql(source))
        q[f"status_runs{sfx}"] = Query(_stored_runs("status_runs", source, run_status, expand_run_status), oracle.user_day_status_sql(source))
        q[f"view_sink{sfx}"] = Query(_view_sink(source), oracle.triangle_sql(source, "week"))
        stored = {
            "calendar": oracle.calendar_sql(source),
            "dim_users": oracle.dim_users_sql(source),
            "fct_events": oracle.fct_events_sql(source),
            "event_ordinal": oracle.event_ordinal_sql(source),
        } | {f"triangle_retention_{name}": oracle.triangle_sql(source, grain) for grain, name in GRAIN_NAME.items()}
        for model, sql in stored.items():
            q[f"stored_view_{model}{sfx}"] = Query(_stored_view(source, model), sql)
    # Names of the first registrations.
    for old, new in EARLIER_NAMES.items():
        q[old] = q[new]
    return q


REGISTRY: dict[str, Query] = _build()

# The flagship query (daily growth accounting on the events adapter).
FLAGSHIP = "growth_daily"
