"""Hand-built cases with worked answers (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lifetide.operators import (
    calendar,
    dim_users,
    event_ordinal,
    fact_events,
    growth,
    triangle,
    user_day_activity,
    user_day_spine,
    user_day_status,
)
from tests.conftest import make_events, ts

D = dt.date.fromisoformat


def _null_first(row):
    return tuple((x is not None, x) for x in row)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_null_first)


def test_f1_day_statuses(spark):
    ev = make_events(spark, [
        (ts("2024-01-01"), 1, "click"), (ts("2024-01-02"), 1, "click"), (ts("2024-01-05"), 1, "click"),
        (ts("2024-01-03"), 2, "click"),
    ])
    st = user_day_status(user_day_spine(user_day_activity(ev)))
    got = rows(st, "user_id", "cal_day", "trns_day", "prev_day", "new_user", "active", "retained",
               "resurrected", "churned", "trns_type")
    assert got == [
        (1, D("2024-01-01"), D("2024-01-01"), None, 1, 1, None, None, None, "Engagement"),
        (1, D("2024-01-02"), D("2024-01-02"), D("2024-01-01"), None, 1, 1, None, None, "Engagement"),
        (1, D("2024-01-03"), None, D("2024-01-02"), None, None, None, None, 1, "Churned"),
        (1, D("2024-01-04"), None, None, None, None, None, None, None, "No Activity"),
        (1, D("2024-01-05"), D("2024-01-05"), None, None, 1, None, 1, None, "Engagement"),
        (2, D("2024-01-03"), D("2024-01-03"), None, 1, 1, None, None, None, "Engagement"),
    ]


def _counts(long_df, period_col):
    out = {}
    for r in long_df.collect():
        out[(r[period_col], r["trns_type"], r["user_type"])] = (r["user_cnt"], r["miles_pct"])
    return out


def test_f1_growth_daily_long(spark):
    ev = make_events(spark, [
        (ts("2024-01-01"), 1, "click"), (ts("2024-01-02"), 1, "click"), (ts("2024-01-05"), 1, "click"),
        (ts("2024-01-03"), 2, "click"),
    ])
    g = _counts(growth(user_day_activity(ev), "day"), "cal_day")
    assert g[(D("2024-01-01"), "Engagement", "new_users")] == (1, 0)
    assert g[(D("2024-01-02"), "Engagement", "retained")] == (1, 0)
    assert g[(D("2024-01-03"), "Churned", "tot_churned")] == (1, 0)
    assert g[(D("2024-01-03"), "Churned", "churned")] == (-1, 0)
    assert g[(D("2024-01-03"), "Engagement", "new_users")] == (1, 0)
    assert g[(D("2024-01-04"), "No Activity", "active")] == (0, 0)
    assert g[(D("2024-01-05"), "Engagement", "resurrected")] == (1, 0)
    # No churn after the last activity: 01-04 is the only No Activity day.
    assert {k[0] for k in g if k[1] == "No Activity"} == {D("2024-01-04")}
    # Engagement-only days have miles sums of 0, which are reported.
    assert g[(D("2024-01-01"), "Engagement", "miles_earned")] == (0, 0)


def _user_types(long_df, period_cols, period):
    out = {}
    for r in long_df.collect():
        key = tuple(r[c] for c in period_cols)
        if key == period:
            out.setdefault(r["trns_type"], {})[r["user_type"]] = r["user_cnt"]
    return out


def test_f2_week_pieces_parity_vs_strict(spark):
    ev = make_events(spark, [
        (ts("2024-01-28"), 1, "click"), (ts("2024-02-02"), 1, "click"), (ts("2024-02-20"), 1, "click"),
    ])
    act = user_day_activity(ev)
    keys = ["cal_week", "cal_month"]
    par = growth(act, "week")
    assert _user_types(par, keys, (D("2024-01-28"), D("2024-01-01")))["Engagement"]["new_users"] == 1
    assert _user_types(par, keys, (D("2024-01-28"), D("2024-02-01")))["Engagement"]["retained"] == 1
    assert set(_user_types(par, keys, (D("2024-02-04"), D("2024-02-01")))) == {"No Activity"}
    assert set(_user_types(par, keys, (D("2024-02-11"), D("2024-02-01")))) == {"No Activity"}
    assert _user_types(par, keys, (D("2024-02-18"), D("2024-02-01")))["Engagement"]["retained"] == 1

    strict = growth(act, "week", mode="strict")
    first = _user_types(strict, keys, (D("2024-01-28"), D("2024-01-01")))
    assert first["Engagement"]["new_users"] == 1 and first["Engagement"]["active"] == 1
    assert _user_types(strict, keys, (D("2024-01-28"), D("2024-02-01"))) == {}
    churn = _user_types(strict, keys, (D("2024-02-04"), D("2024-02-01")))
    assert churn == {"Churned": {"tot_churned": 1, "churned": -1}}
    assert set(_user_types(strict, keys, (D("2024-02-11"), D("2024-02-01")))) == {"No Activity"}
    assert _user_types(strict, keys, (D("2024-02-18"), D("2024-02-01")))["Engagement"]["resurrected"] == 1


def test_f2_monthly_parity_vs_strict(spark):
    ev = make_events(spark, [
        (ts("2024-01-28"), 1, "click"), (ts("2024-02-02"), 1, "click"), (ts("2024-02-20"), 1, "click"),
        (ts("2024-04-10"), 1, "click"),
    ])
    act = user_day_activity(ev)
    par = growth(act, "month")
    strict = growth(act, "month", mode="strict")
    m = ["cal_month"]
    assert _user_types(par, m, (D("2024-02-01"),))["Engagement"]["retained"] == 1
    assert _user_types(strict, m, (D("2024-02-01"),))["Engagement"]["retained"] == 1
    assert set(_user_types(par, m, (D("2024-03-01"),))) == {"No Activity"}
    assert _user_types(strict, m, (D("2024-03-01"),)) == {"Churned": {"tot_churned": 1, "churned": -1}}
    assert _user_types(par, m, (D("2024-04-01"),))["Engagement"]["retained"] == 1
    assert _user_types(strict, m, (D("2024-04-01"),))["Engagement"]["resurrected"] == 1


F3_CASES = [
    # events of the day, (activity, trns, earned, redeemed), type, parity sub-type, strict sub-type
    ([("click", None)], (1, 0, 0, 0), "Engagement", "Engagement", "Engagement"),
    ([(None, None)], (1, 0, 0, 0), "Engagement", "Engagement", "Engagement"),
    ([("miles_earned", 10)], (0, 1, 10, 0), "Miles", "Miles Earned Only", "Miles Earned Only"),
    ([("miles_redeemed", 5)], (0, 1, 0, 5), "Miles", "Miles Earned & Redeemed", "Miles Redemption Only"),
    ([("miles_earned", 10), ("miles_redeemed", 5)], (0, 2, 10, 5), "Miles", "Miles Earned & Redeemed",
     "Miles Earned & Redeemed"),
    ([("miles_redeemed", None)], (0, 1, 0, None), "Miles", "Miles Redemption Only", "Miles Redemption Only"),
    ([("miles_earned", None)], (0, 1, None, 0), "Miles", "Miles Earned Only", "Miles Earned Only"),
    ([("click", None), ("miles_earned", 10)], (1, 1, 10, 0), "Miles & Engagement", "Engagement & Miles Earned",
     "Engagement & Miles Earned"),
    ([("click", None), ("miles_redeemed", 5)], (1, 1, 0, 5), "Miles & Engagement", "Engagement & Earn & Redeem",
     "Engagement & Miles Redemption"),
]


def test_f3_labels(spark):
    raw = []
    for uid, (events, *_rest) in enumerate(F3_CASES, start=1):
        for i, (etype, amount) in enumerate(events):
            raw.append((ts("2024-01-01", f"10:00:0{i}"), uid, etype, amount))
    spine = user_day_spine(user_day_activity(make_events(spark, raw)))
    parity = {r["user_id"]: r for r in user_day_status(spine).collect()}
    strict = {r["user_id"]: r for r in user_day_status(spine, strict_subtype=True).collect()}
    for uid, (_, measures, ttype, sub_p, sub_s) in enumerate(F3_CASES, start=1):
        r = parity[uid]
        assert (r["activity"], r["trns"], r["miles_earned"], r["miles_redeemed"]) == measures, uid
        assert r["trns_type"] == ttype, uid
        assert r["trns_sub_type"] == sub_p, uid
        assert strict[uid]["trns_sub_type"] == sub_s, uid


def test_f3_earn_null_alone_emits_only_redeemed_miles_row(spark):
    ev = make_events(spark, [(ts("2024-01-01"), 1, "miles_earned", None)])
    long = growth(user_day_activity(ev), "day")
    miles = sorted(r["user_type"] for r in long.collect() if r["user_type"].startswith("miles"))
    assert miles == ["miles_redeemed"]


def test_f4_triangle_daily(spark):
    ev = make_events(spark, [
        (ts("2024-01-01"), 1, "click"), (ts("2024-01-01"), 2, "click"), (ts("2024-01-03"), 1, "click"),
        (ts("2024-01-02"), 3, "click"),
    ])
    got = rows(triangle(ev, "day"), "cohort_date", "period_offset", "users", "cohort_size", "retention_rate")
    assert got == [
        (D("2024-01-01"), 0, 2, 2, 1.0),
        (D("2024-01-01"), 2, 1, 2, 0.5),
        (D("2024-01-02"), 0, 1, 1, 1.0),
    ]


def test_f5_empty_source(spark):
    ev = make_events(spark, [])
    act = user_day_activity(ev)
    for df in (calendar(ev), dim_users(ev), fact_events(ev), event_ordinal(ev), user_day_spine(act),
               growth(act, "day"), growth(act, "week"), growth(act, "month", mode="strict"), triangle(ev, "week")):
        assert df.count() == 0


def test_f5_nulls_and_ties(spark):
    ev = make_events(spark, [
        (ts("2024-01-01", "09:00:00"), 1, "click", None, "ios", "a", "US"),
        (ts("2024-01-01", "09:00:00"), 1, "click", None, "web", "b", "SG"),  # tie at first instant
        (ts("2024-01-02"), 1, "click"),
        (None, 1, "click"),  # NULL time, known user
        (ts("2024-01-01"), None, "click"),  # NULL user
        (None, 9, "click"),  # user with no timed event
    ])
    assert fact_events(ev).count() == 6
    assert event_ordinal(ev).count() == 6
    du = rows(dim_users(ev), "user_id", "first_platform")
    assert du == [(1, "ios"), (1, "web")]
    spine = user_day_spine(user_day_activity(ev))
    assert rows(spine, "user_id", "cal_day") == [(1, D("2024-01-01")), (1, D("2024-01-02"))]
    tri = rows(triangle(ev, "day"), "cohort_date", "period_offset", "users")
    # User 1 also has a NULL-time event: a NULL-offset row; user 9 has no cohort.
    assert (D("2024-01-01"), None, 1) in tri and len(tri) == 3
    cal = rows(calendar(ev), "day")
    assert cal == [(D("2024-01-01"),), (D("2024-01-02"),)]


def test_f5_event_ordinal_numbers(spark):
    ev = make_events(spark, [
        (None, 1, "click"),
        (ts("2024-01-01", "09:00:00"), 1, "click"),
        (ts("2024-01-01", "09:00:00"), 1, "click"),
        (ts("2024-01-01", "11:30:00"), 1, "click"),
        (ts("2024-01-03", "08:00:00"), 1, "click"),
        (ts("2024-01-01"), None, "click"),
        (ts("2024-01-02"), None, "click"),
    ])
    got = rows(event_ordinal(ev).withColumn("t", F.col("event_time").cast("string")), "user_id", "t", "session_number")
    assert got == sorted([
        (1, None, 1), (1, "2024-01-01 09:00:00", 2), (1, "2024-01-01 09:00:00", 3),
        (1, "2024-01-01 11:30:00", 4), (1, "2024-01-03 08:00:00", 5),
        (None, "2024-01-01 12:00:00", 1), (None, "2024-01-02 12:00:00", 2),
    ], key=_null_first)


def test_f5_week_and_month_boundaries(spark):
    ev = make_events(spark, [
        (ts("2024-01-06"), 1, "click"), (ts("2024-01-07"), 1, "click"),  # Saturday / Sunday
        (ts("2024-01-31"), 2, "click"), (ts("2024-02-01"), 2, "click"),  # month boundary
    ])
    w = rows(triangle(ev, "week"), "cohort_week_date", "period_offset", "users")
    assert (D("2023-12-31"), 1, 1) in w
    m = rows(triangle(ev, "month"), "cohort_month_date", "period_offset", "users")
    assert (D("2024-01-01"), 1, 1) in m
