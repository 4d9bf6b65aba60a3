"""Calendar building blocks against Python date arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lifetide.functions.periods import (
    month_start_sql,
    next_period_sql,
    period_offset_sql,
    period_start_sql,
    week_start_sql,
)
from lifetide.operators.growth import _units

DAYS = [dt.date(2023, 12, 24) + dt.timedelta(days=i) for i in range(0, 800, 3)]


def py_week(d: dt.date) -> dt.date:
    return d - dt.timedelta(days=(d.weekday() + 1) % 7)  # Sunday on or before


def py_month(d: dt.date) -> dt.date:
    return d.replace(day=1)


def py_add_months(d: dt.date, n: int) -> dt.date:
    y, m = divmod(d.month - 1 + n, 12)
    return dt.date(d.year + y, m + 1, 1)


def test_week_and_month_starts(spark):
    df = spark.createDataFrame([(d,) for d in DAYS], "d date")
    got = df.select("d", F.expr(week_start_sql("d")).alias("w"), F.expr(month_start_sql("d")).alias("m")).collect()
    for r in got:
        assert r["w"] == py_week(r["d"]) and r["w"].weekday() == 6
        assert r["m"] == py_month(r["d"])


def test_period_offsets_and_next_periods(spark):
    pairs = [(a, b) for a in DAYS[::9] for b in DAYS[::11] if b >= a]
    df = spark.createDataFrame(pairs, "a date, b date")
    cols = []
    for g in ("day", "week", "month"):
        sa, sb = f"s_a_{g}", f"s_b_{g}"
        df = df.withColumn(sa, F.expr(period_start_sql("a", g))).withColumn(sb, F.expr(period_start_sql("b", g)))
        cols += [F.expr(period_offset_sql(sb, sa, g)).alias(f"off_{g}"), F.expr(next_period_sql(sa, g, 2)).alias(f"nx_{g}")]
    for r in df.select("a", "b", *cols).collect():
        a, b = r["a"], r["b"]
        assert r["off_day"] == (b - a).days
        assert r["off_week"] == (py_week(b) - py_week(a)).days // 7
        assert r["off_month"] == (b.year - a.year) * 12 + b.month - a.month
        assert r["nx_day"] == a + dt.timedelta(days=2)
        assert r["nx_week"] == py_week(a) + dt.timedelta(days=14)
        assert r["nx_month"] == py_add_months(a, 2)


def test_unit_starts_and_next_unit(spark):
    """Week pieces split at month starts; ``nxt`` is the first unit start on
    or after a day, for every grain and mode."""
    df = spark.createDataFrame([(d,) for d in DAYS], "d date")
    specs = [("day", "parity"), ("week", "parity"), ("week", "strict"), ("month", "parity")]
    exprs = []
    for g, m in specs:
        u = _units(g, m)
        exprs += [F.expr(u.start("d")).alias(f"s_{g}_{m}"), F.expr(u.nxt("d")).alias(f"n_{g}_{m}")]
    for r in df.select("d", *exprs).collect():
        d = r["d"]
        piece = max(py_week(d), py_month(d))
        assert r["s_day_parity"] == d and r["n_day_parity"] == d
        assert r["s_week_parity"] == piece
        assert r["s_week_strict"] == py_week(d)
        assert r["s_month_parity"] == py_month(d)
        next_piece = d if piece == d else min(py_week(d) + dt.timedelta(days=7), py_add_months(d, 1))
        assert r["n_week_parity"] == next_piece
        assert r["n_week_strict"] == (d if py_week(d) == d else py_week(d) + dt.timedelta(days=7))
        assert r["n_month_parity"] == (d if d.day == 1 else py_add_months(d, 1))
