"""Dashboard tables: cohort heatmap, status report, transaction breakdown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifetide.functions.labels import ACTIVE_TYPES, CHURNED, USER_TYPES, trns_type_sql
from lifetide.functions.periods import period_offset_sql, period_start_sql
from lifetide.operators.activity import MEASURES, measure_types
from lifetide.operators.growth import consolidated_groups
from lifetide.operators.retention import COHORT_COLUMN


def _cohort_cells(tri: DataFrame, grain: str) -> DataFrame:
    """One row per cohort: a map of its offsets' cells (at most one per calendar
    period), its size, and the offset ``last_offset`` of the last period that
    any cohort reaches.  One aggregation of the triangle, then the last period
    over that small table."""
    cohort = COHORT_COLUMN[grain]
    period = {
        "day": "date_add({c}, CAST(period_offset AS INT))",
        "week": "date_add({c}, CAST(period_offset * 7 AS INT))",
        "month": "add_months({c}, CAST(period_offset AS INT))",
    }[grain].format(c=cohort)
    per_cohort = (
        tri.where("period_offset IS NOT NULL")
        .groupBy(cohort)
        .agg(
            F.expr("map_from_entries(collect_list(struct(period_offset, struct(users, retention_rate)))) AS cells"),
            F.max("cohort_size").alias("cohort_size"),
            F.expr(f"max({period}) AS last"),
        )
    )
    ended = per_cohort.withColumn("last", F.expr("max(last) OVER ()"))
    return ended.select(cohort, "cohort_size", "cells", F.expr(period_offset_sql("last", cohort, grain)).alias("last_offset"))


def cohort_matrix(tri: DataFrame, grain: str = "day") -> DataFrame:
    """The triangle heatmap's cells: one row per cohort and offset from 0 to
    the last period that any cohort reaches, with ``users`` 0 and a NULL
    ``retention_rate`` where nobody returned.  One scan, a fixed schema, no
    limit on offsets and no job before the action.
    """
    cohort = COHORT_COLUMN[grain]
    grid = _cohort_cells(tri, grain).select(cohort, "cohort_size", "cells", F.expr("explode(sequence(0L, last_offset)) AS period_offset"))
    return grid.select(
        cohort,
        "period_offset",
        F.expr("coalesce(cells[period_offset].users, 0L) AS users"),
        "cohort_size",
        F.expr("cells[period_offset].retention_rate AS retention_rate"),
    )


def cohort_matrix_wide(tri: DataFrame, grain: str = "day") -> DataFrame:
    """The heatmap with one row per cohort: ``users`` and ``retention_rates``
    are arrays whose element ``i`` is offset ``i``, up to the last period that
    any cohort reaches.  The schema does not depend on the data, so no job
    finds the offsets first, as a pivot would need."""
    cells = _cohort_cells(tri, grain)
    return cells.select(
        COHORT_COLUMN[grain],
        "cohort_size",
        F.expr("transform(sequence(0L, last_offset), o -> coalesce(cells[o].users, 0L)) AS users"),
        F.expr("transform(sequence(0L, last_offset), o -> cells[o].retention_rate) AS retention_rates"),
    )


def status_report(activity: DataFrame, grain: str = "day", mode: str = "parity") -> DataFrame:
    """Per period: one column per user type with the summed counts, taken from
    the consolidated groups before they are unpivoted.  A type that has no
    group in the period is NULL."""
    groups = consolidated_groups(activity, grain, mode)
    keys = [c for c in groups.columns if c.startswith("cal_")]
    stay = f"CASE WHEN trns_type <> '{CHURNED}' THEN {{}} END"
    gone = f"CASE WHEN trns_type = '{CHURNED}' THEN pos_churned END"
    counts = {t: stay.format(t) for t in ("new_users", "retained", "resurrected", "active")}
    counts |= {"tot_churned": gone, "churned": f"-({gone})"}
    return groups.groupBy(*keys).agg(*[F.expr(f"CAST(sum({counts[t]}) AS BIGINT) AS {t}") for t in USER_TYPES])


def status_report_of(growth_long: DataFrame, keys: list[str]) -> DataFrame:
    """The same from a stored long growth table."""
    return growth_long.groupBy(*keys).pivot("user_type", USER_TYPES).agg(F.sum("user_cnt").cast("bigint"))


def transaction_breakdown(activity: DataFrame, grain: str = "day") -> DataFrame:
    """Active users per period and transaction type (Engagement / Miles /
    Miles & Engagement), the type taken from each user's period sums.

    Works on the per user-day measures: partial aggregation to
    (user, period), then a small group-by; the spine is not needed."""
    act = activity.where("user_id IS NOT NULL AND day IS NOT NULL")
    types = measure_types(activity)
    if grain == "day":
        per = act.selectExpr("day AS period_start", "user_id", *MEASURES)
    else:
        per = act.groupBy(F.expr(period_start_sql("day", grain)).alias("period_start"), "user_id").agg(
            *[F.expr(f"CAST(sum({m}) AS {t}) AS {m}") for m, t in types.items()]
        )
    labelled = per.withColumn("trns_type", F.expr(trns_type_sql()))
    return (
        labelled.where(F.col("trns_type").isin(*ACTIVE_TYPES))
        .groupBy("period_start", "trns_type")
        .agg(
            F.count(F.lit(1)).alias("users"),
            F.sum("trns_activity").cast("bigint").alias("events"),
            F.sum("miles_earned").cast(types["miles_earned"]).alias("miles_earned"),
            F.sum("miles_redeemed").cast(types["miles_redeemed"]).alias("miles_redeemed"),
        )
    )
