"""Invariants of the growth and retention tables on seeded random streams."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lifetide.functions.periods import period_start_sql
from lifetide.operators import growth, triangle, user_day_activity, user_day_spine
from lifetide.sources.events import from_events_table
from tests.test_oracle import random_events


@pytest.fixture(scope="module", params=[3, 5])
def events(spark, request):
    pdf = random_events(request.param, n=500)
    return from_events_table(spark.createDataFrame(pdf))


def _by_period(long_df, key):
    out = defaultdict(lambda: defaultdict(int))
    for r in long_df.collect():
        out[r[key]][r["user_type"]] += r["user_cnt"]
    return out


def test_daily_active_is_new_plus_retained_plus_resurrected(events):
    per_day = _by_period(growth(user_day_activity(events), "day"), "cal_day")
    for day, c in per_day.items():
        assert c["active"] == c["new_users"] + c["retained"] + c["resurrected"], day
        assert c["churned"] == -c["tot_churned"], day


def test_new_users_sum_to_users(events):
    act = user_day_activity(events)
    users = act.where(F.col("user_id").isNotNull() & F.col("day").isNotNull()).select("user_id").distinct().count()
    for grain, mode in (("day", "parity"), ("week", "parity"), ("month", "parity"), ("week", "strict")):
        per = _by_period(growth(act, grain, mode=mode), "cal_month")
        assert sum(c["new_users"] for c in per.values()) == users, (grain, mode)


def test_strict_churn_is_resurrections_and_departures(events):
    """Every strict-mode churn is followed by one resurrection, or is the
    departure of a user whose last period is not the calendar's last."""
    act = user_day_activity(events.where("user_id % 2 = 0 OR event_time < '2024-02-20'"))
    for grain in ("week", "month"):
        per = _by_period(growth(act, grain, mode="strict"), "cal_month")
        period = F.expr(period_start_sql("day", grain))
        last = act.where("day IS NOT NULL").agg(F.max(period)).first()[0]
        lasts = act.where("user_id IS NOT NULL AND day IS NOT NULL").groupBy("user_id").agg(F.max(period).alias("p"))
        left = lasts.where(F.col("p") < F.lit(last)).count()
        assert left and sum(c["tot_churned"] for c in per.values()) == sum(c["resurrected"] for c in per.values()) + left


def test_triangle_offset_zero_rate_is_one(events):
    for grain in ("day", "week", "month"):
        for r in triangle(events, grain).where("period_offset = 0").collect():
            assert r["retention_rate"] == 1.0 and r["users"] == r["cohort_size"]


def test_spine_length_is_span(events):
    spine = user_day_spine(user_day_activity(events))
    per_user = spine.groupBy("user_id").agg(
        F.count("*").alias("n"), F.min("cal_day").alias("lo"), F.max("cal_day").alias("hi"),
        F.countDistinct("cal_day").alias("d"),
    ).collect()
    for r in per_user:
        assert r["n"] == r["d"] == (r["hi"] - r["lo"]).days + 1


def test_input_order_does_not_matter(events):
    a = growth(user_day_activity(events), "week").collect()
    b = growth(user_day_activity(events.orderBy(F.rand(1)).repartition(7)), "week").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
