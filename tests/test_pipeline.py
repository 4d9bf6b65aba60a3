"""The table-building pipeline writes every model and agrees with the
standalone queries."""

from __future__ import annotations

import os
import tempfile

import pytest

from lifetide.operators import triangle, triangle_from_days, user_day_activity, user_days
from lifetide.plans.pipeline import build_all
from lifetide.plans.queries import REGISTRY
from lifetide.sources.events import load_source
from tests.compare import spark_rows

SF = "/root/testdata/sf0.001"

SAME = {
    "calendar": "events_calendar",
    "dim_users": "dim_users",
    "fct_events": "fct_events",
    "event_ordinal": "event_ordinal",
    "growth_transactions": "user_day_spine",
    "growth_accounting_frm_day": "user_day_status",
    "growth_accounting_daily": "growth_daily",
    "growth_accounting_weekly": "growth_weekly",
    "growth_accounting_monthly": "growth_monthly",
    "growth_accounting_weekly_strict": "growth_weekly_strict",
    "growth_accounting_monthly_strict": "growth_monthly_strict",
    "growth_accounting_consolidated": "growth_consolidated",
    "triangle_retention_daily": "triangle_daily",
    "triangle_retention_weekly": "triangle_weekly",
    "triangle_retention_monthly": "triangle_monthly",
    **{f"{r}_{g}": f"{r}_{g}" for r in ("cohort_matrix", "status_report", "transaction_breakdown") for g in ("daily", "weekly", "monthly")},
}


def test_build_all_matches_queries(spark):
    if not os.path.exists(f"{SF}/events.parquet"):
        pytest.skip("driver test data not present")
    out = tempfile.mkdtemp(prefix="lifetide-out-")
    stage_root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    stages_before = {d for d in os.listdir(stage_root) if d.startswith("lifetide-stage-")}
    paths = build_all(
        spark, load_source(spark, SF, "events"), out, register_views=True,
        partition_by={"growth_transactions": ["cal_day"]},
    )
    assert set(SAME) <= set(paths)
    assert any(p.startswith("cal_day=") for p in os.listdir(paths["growth_transactions"]))
    stages_after = {d for d in os.listdir(stage_root) if d.startswith("lifetide-stage-")}
    assert stages_after == stages_before
    for model, key in SAME.items():
        stored = spark.table(model)
        want = REGISTRY[key].run(spark, SF)
        cs, rs = spark_rows(stored)
        cw, rw = spark_rows(want)
        assert cs == cw, model
        assert sorted(map(repr, rs)) == sorted(map(repr, rw)), model


def test_build_all_without_spine_keeps_stage_on_request(spark):
    if not os.path.exists(f"{SF}/events.parquet"):
        pytest.skip("driver test data not present")
    out = tempfile.mkdtemp(prefix="lifetide-out-")
    paths = build_all(spark, load_source(spark, SF, "orders"), out, include_spine=False, keep_stage=True)
    assert "growth_transactions" not in paths and "growth_accounting_frm_day" not in paths
    stored = spark.read.parquet(paths["growth_accounting_weekly"])
    want = REGISTRY["growth_weekly_orders"].run(spark, SF)
    assert sorted(map(repr, spark_rows(stored)[1])) == sorted(map(repr, spark_rows(want)[1]))
    stage_root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    staged = [d for d in os.listdir(stage_root) if d.startswith("lifetide-stage-")]
    assert any(os.path.exists(f"{stage_root}/{d}/user_days") for d in staged)


@pytest.mark.parametrize("source", ["events", "orders"])
def test_triangle_from_stored_days_needs_no_user_shuffle(spark, source):
    if not os.path.exists(f"{SF}/events.parquet"):
        pytest.skip("driver test data not present")
    path = tempfile.mkdtemp(prefix="lifetide-days-")
    events = load_source(spark, SF, source)
    user_days(user_day_activity(events)).write.mode("overwrite").parquet(path)
    days = spark.read.parquet(path)
    for grain in ("day", "week", "month"):
        got = triangle_from_days(days, grain)
        plan = got._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert exchanges and all("user_id" not in line for line in exchanges)
        want = triangle(events, grain)
        assert sorted(map(repr, spark_rows(got)[1])) == sorted(map(repr, spark_rows(want)[1]))


def test_failed_build_leaves_no_stage(spark):
    stage_root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    before = set(os.listdir(stage_root))
    events = load_source(spark, SF, "events")
    with pytest.raises(Exception):
        build_all(spark, events, tempfile.mkdtemp(), partition_by={"fct_events": ["no_such_column"]})
    assert {d for d in set(os.listdir(stage_root)) - before if d.startswith("lifetide-stage-")} == set()


def test_lazy_views_follow_the_events(spark):
    out, src = tempfile.mkdtemp(prefix="lifetide-out-"), tempfile.mkdtemp(prefix="lifetide-src-")
    events = load_source(spark, SF, "events")
    events.limit(500).write.mode("overwrite").parquet(src)
    paths = build_all(spark, spark.read.parquet(src), out, include_spine=False, lazy_views=True)
    assert "dim_users" not in paths and "triangle_retention_daily" not in paths and "growth_accounting_daily" in paths
    assert spark.table("event_ordinal").count() == 500
    assert sorted(map(repr, spark_rows(spark.table("triangle_retention_weekly"))[1])) == sorted(
        map(repr, spark_rows(triangle(spark.read.parquet(src), "week"))[1])
    )
