"""Growth accounting: new / retained / resurrected / churned / active users.

Output is a long metric table (one row per
period x trns_type x trns_sub_type x user_type with ``user_cnt`` and
``miles_pct``, the latter being a SUM of miles).

The statuses are computed from *active* user-periods alone; the gap-filled
user x day spine is never built here.

* Each active unit (a day, a (Sunday week, month) piece, a week or a month)
  of a user is one row carrying its summed measures.  One window over the
  user's active days (bounded by the calendar span, whatever the event
  count) gives each unit the previous active day, hence the previous
  active unit.
* An active unit is new when it is the user's first; otherwise retained or
  resurrected by whether the previous *calendar* unit was active (``day``
  and the ``strict`` modes).  In ``parity`` week / month mode the lag runs
  over every spine piece, so any non-first active piece is retained.
* A gap between two active units yields one Churned unit (the first idle
  unit; day and strict modes) and No Activity units after it (all idle
  units in parity week / month mode).
* After the last active unit, ``parity`` yields nothing: the spine ends
  there.  ``strict`` counts the departure: a Churned unit in the period after
  the last one if the calendar reaches it, then No Activity to its end.
* No Activity rows carry no count, only their existence matters: a unit
  has one when any user's gap covers it.  That is a +1/-1 sweep over the
  gap ends aggregated per unit start, so its size is the number of
  calendar units, never users x days.

Counts are plain ``count``: within one (period, type, sub-type) group a
user has at most one row, so ``COUNT(DISTINCT user)`` equals ``COUNT`` and
Spark's Expand-based multi-distinct plan is avoided.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lifetide.functions.labels import (
    BREAKDOWN,
    CHURNED,
    MILES_TYPES,
    NO_ACTIVITY,
    TOTAL,
    USER_TYPES,
    status_labels,
)
from lifetide.functions.periods import month_start_sql, next_period_sql, week_start_sql
from lifetide.operators.activity import MEASURES, measure_types, user_days

MODES = ("parity", "strict")
COUNT_COLUMNS = ["new_users", "retained", "resurrected", "pos_churned", "active"]
KIND_ACTIVE, KIND_CHURN, KIND_SWEEP, KIND_CALENDAR = 0, 1, 2, 3


@dataclass(frozen=True)
class _Units:
    """How days map to the units a status is computed for (SQL text builders)."""

    start: Callable[[str], str]  # unit start of a day
    keys: Callable[[str], list[str]]  # output period columns of a unit start
    key_names: list[str]
    nxt: Callable[[str], str]  # first unit start on or after a day
    step: str | None  # grain of "previous unit" for adjacency, None = parity pieces


def _units(grain: str, mode: str) -> _Units:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {MODES}")
    if grain == "day":
        return _Units(
            start=lambda d: d,
            keys=lambda s: [f"{s} AS cal_day", f"{month_start_sql(s)} AS cal_month"],
            key_names=["cal_day", "cal_month"],
            nxt=lambda x: x,
            step="day",
        )
    if grain == "month":
        return _Units(
            start=month_start_sql,
            keys=lambda s: [f"{s} AS cal_month"],
            key_names=["cal_month"],
            nxt=lambda x: f"CASE WHEN dayofmonth({x}) = 1 THEN {x} ELSE add_months({month_start_sql(x)}, 1) END",
            step="month" if mode == "strict" else None,
        )
    if grain == "week" and mode == "strict":
        return _Units(
            start=week_start_sql,
            keys=lambda s: [f"{s} AS cal_week", f"{month_start_sql(s)} AS cal_month"],
            key_names=["cal_week", "cal_month"],
            nxt=lambda x: f"CASE WHEN {week_start_sql(x)} = {x} THEN {x} ELSE date_add({week_start_sql(x)}, 7) END",
            step="week",
        )
    if grain == "week":
        # A week that crosses a month is two pieces, one per month.
        def piece(d: str) -> str:
            return f"greatest({week_start_sql(d)}, {month_start_sql(d)})"

        return _Units(
            start=piece,
            keys=lambda s: [f"{week_start_sql(s)} AS cal_week", f"{month_start_sql(s)} AS cal_month"],
            key_names=["cal_week", "cal_month"],
            nxt=lambda x: (
                f"CASE WHEN {piece(x)} = {x} THEN {x} "
                f"ELSE least(date_add({week_start_sql(x)}, 7), add_months({month_start_sql(x)}, 1)) END"
            ),
            step=None,
        )
    raise ValueError(f"unknown grain {grain!r}")


def active_units(activity: DataFrame, grain: str, mode: str = "parity") -> DataFrame:
    """One row per active (user, unit): unit start ``_s``, summed measures,
    the previous active unit's start ``_prev_s`` and last active day
    ``_prev_last`` (NULL for the user's first unit), and the next active day
    ``_next_day`` (NULL for the user's last unit).

    The neighbours are those of the user's active *days* (one exchange by
    user, none where ``activity`` has them stored); the previous active day of
    a unit's first day is the last day of the previous active unit.  Rolling
    days up to units afterwards keeps the user partitioning.  ``strict`` also
    keeps the rows of unknown users, which tell how far the calendar goes.
    """
    u = _units(grain, mode)
    known = "day IS NOT NULL" if mode == "strict" else "user_id IS NOT NULL AND day IS NOT NULL"
    types = measure_types(activity)
    days = user_days(activity.where(known)).select("user_id", "day", *MEASURES, "prev_active", "next_active")
    if grain == "day":
        per_unit = days.selectExpr(
            "user_id", "day AS _s", *MEASURES, "prev_active AS _prev_last", "next_active AS _next_day"
        )
    else:
        per_unit = days.groupBy("user_id", F.expr(u.start("day")).alias("_s")).agg(
            *[F.expr(f"CAST(sum({m}) AS {t}) AS {m}") for m, t in types.items()],
            F.expr("min_by(prev_active, day) AS _prev_last"),
            F.expr("max_by(next_active, day) AS _next_day"),
        )
    return per_unit.selectExpr("*", f"{u.start('_prev_last')} AS _prev_s")


def _entry(
    kind: int, start: str, ttype: str, sub: str, counts: list[str], d: str, measures: list[str], types: dict[str, str]
) -> str:
    fields = [f"'kind', {kind}", f"'_s', {start}", f"'trns_type', {ttype}", f"'trns_sub_type', {sub}"]
    fields += [f"'{n}', CAST({c} AS BIGINT)" for n, c in zip(COUNT_COLUMNS, counts)]
    fields += [f"'_d', CAST({d} AS BIGINT)"]
    fields += [f"'{m}', CAST({v} AS {types[m]})" for m, v in zip(MEASURES, measures)]
    return f"named_struct({', '.join(fields)})"


def consolidated_groups(
    activity: DataFrame, grain: str = "day", mode: str = "parity", strict_subtype: bool | None = None
) -> DataFrame:
    """Per (period, trns_type, trns_sub_type): the five user counts and the
    summed measures.

    One linear plan, so the events are scanned and aggregated once:

    1. every active unit emits tagged contributions: its own active group,
       the Churned unit after a gap (day / strict modes), +1 / -1 sweep
       deltas bounding the No Activity units of that gap, and in strict mode,
       after the user's last unit, its Churned unit and an open sweep;
    2. one aggregation by (kind, unit start, type, sub-type), with partial
       aggregation, leaves at most a few rows per calendar unit;
    3. a running sum of the deltas (window per kind, over that small table)
       marks the covered stretches, which expand to their unit starts; open
       ones, and late Churned units, end with the calendar's last unit.
    """
    u = _units(grain, mode)
    strict = mode == "strict"
    if strict_subtype is None:
        strict_subtype = strict
    types = measure_types(activity)
    first = "_prev_s IS NULL"
    if u.step is None:
        retained = f"NOT {first}"
        churn_at = None
        sweep_lo = u.nxt("date_add(_prev_last, 1)")
    else:
        retained = f"NOT {first} AND {next_period_sql('_prev_s', u.step)} = _s"
        churn_at = next_period_sql("_prev_s", u.step)
        sweep_lo = next_period_sql("_prev_s", u.step, 2)
    labels = status_labels("false", strict_subtype)

    def flag(cond: str) -> str:
        return f"CASE WHEN {cond} THEN 1 ELSE 0 END"

    nulls = ["NULL"] * len(MEASURES)
    zeros = ["0"] * len(COUNT_COLUMNS)
    no_type = "CAST(NULL AS STRING)"

    def churn(at: str) -> str:
        return _entry(KIND_CHURN, at, f"'{CHURNED}'", f"'{CHURNED}'", ["0", "0", "0", "1", "0"], "0", nulls, types)

    def sweep(at: str, d: str) -> str:
        return _entry(KIND_SWEEP, at, no_type, no_type, zeros, d, nulls, types)

    entries = [
        _entry(
            KIND_ACTIVE, "_s", labels["trns_type"], labels["trns_sub_type"],
            [flag(first), flag(retained), flag(f"NOT ({first}) AND NOT ({retained})"), "0", "1"],
            "0", MEASURES, types,
        )
    ]
    if churn_at is not None:
        entries.append(f"CASE WHEN NOT {first} AND {churn_at} < _s THEN {churn(churn_at)} END")
    has_sweep = f"NOT {first} AND {sweep_lo} < _s"
    for pos, d in ((sweep_lo, "1"), ("_s", "-1")):
        entries.append(f"CASE WHEN {has_sweep} THEN {sweep(pos, d)} END")
    if strict:
        for n, entry in ((1, churn), (2, lambda at: sweep(at, "1"))):
            entries.append(f"CASE WHEN _next_day IS NULL THEN {entry(next_period_sql('_s', u.step, n))} END")
        mark = _entry(KIND_CALENDAR, "_s", no_type, no_type, zeros, "0", nulls, types)
        entries = [f"CASE WHEN user_id IS NOT NULL THEN {e} END" for e in entries]
        entries.append(f"CASE WHEN user_id IS NULL THEN {mark} END")

    contributions = (
        active_units(activity, grain, mode)
        .selectExpr(f"explode(array({', '.join(entries)})) AS c")
        .where("c IS NOT NULL")
        .select("c.*")
    )
    sums = {**dict.fromkeys([*COUNT_COLUMNS, "_d"], "BIGINT"), **types}
    groups = contributions.groupBy("kind", "_s", "trns_type", "trns_sub_type").agg(
        *[F.expr(f"CAST(sum({c}) AS {t}) AS {c}") for c, t in sums.items()]
    )
    # Running sum of the sweep deltas.  Partitioned by kind, the sweep rows
    # form one partition holding at most two rows per calendar unit.
    by_pos = Window.partitionBy("kind").orderBy("_s")
    swept = groups.select(
        "*",
        F.sum("_d").over(by_pos.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_cover"),
        F.lead("_s").over(by_pos).alias("_next"),
    )
    is_sweep = f"kind = {KIND_SWEEP}"
    stop = "date_sub(_next, 1)"
    if strict:
        # The calendar's last unit, over the small table of groups.
        ends = f"CASE WHEN kind IN ({KIND_ACTIVE}, {KIND_CALENDAR}) THEN _s END"
        swept = swept.withColumn("_end", F.expr(f"max({ends}) OVER ()"))
        swept = swept.where(f"_s <= _end AND kind <> {KIND_CALENDAR}")
        stop = f"least(coalesce({stop}, _end), _end)"
    covered = f"filter(sequence(_s, {stop}), d -> {u.start('d')} = d)"
    expanded = swept.selectExpr(
        f"explode(CASE WHEN NOT {is_sweep} THEN array(_s) WHEN _cover > 0 AND {stop} IS NOT NULL THEN {covered} END) AS _unit",
        f"CASE WHEN {is_sweep} THEN '{NO_ACTIVITY}' ELSE trns_type END AS trns_type",
        f"CASE WHEN {is_sweep} THEN '{NO_ACTIVITY}' ELSE trns_sub_type END AS trns_sub_type",
        *COUNT_COLUMNS,
        *MEASURES,
    )
    return expanded.selectExpr(*u.keys("_unit"), "trns_type", "trns_sub_type", *COUNT_COLUMNS, *MEASURES)


def _long_rows(groups: DataFrame, ids: list[str], with_miles: bool) -> DataFrame:
    """Unpivot a consolidated table to the long format in one ``explode``.

    Count labels (new_users, retained, resurrected, tot_churned = churned
    users, churned = minus churned users, active) are kept on non-Churned
    rows except the two churn labels, and on Churned rows only the two
    churn labels; ``type`` is TOTAL for tot_churned.  Miles labels are kept
    for active types when the sum is not NULL, with type TOTAL.  Count rows
    carry ``miles_pct`` 0 and miles rows ``user_cnt`` 0.
    """
    counts = {
        "new_users": "new_users",
        "retained": "retained",
        "resurrected": "resurrected",
        "tot_churned": "pos_churned",
        "churned": "pos_churned * -1",
        "active": "active",
    }
    is_churned = f"trns_type = '{CHURNED}'"
    miles = measure_types(groups)[MILES_TYPES[0]]
    rows = []
    for label in USER_TYPES:
        keep = is_churned if label in ("churned", "tot_churned") else f"NOT {is_churned}"
        kind = TOTAL if label == "tot_churned" else BREAKDOWN
        rows.append(
            f"named_struct('keep', {keep}, 'type', '{kind}', 'user_type', '{label}', "
            f"'user_cnt', CAST({counts[label]} AS BIGINT), 'miles_pct', CAST(0 AS {miles}))"
        )
    if with_miles:
        active_type = f"NOT trns_type IN ('{CHURNED}', '{NO_ACTIVITY}')"
        for label in MILES_TYPES:
            rows.append(
                f"named_struct('keep', {active_type} AND {label} IS NOT NULL, 'type', '{TOTAL}', "
                f"'user_type', '{label}', 'user_cnt', CAST(0 AS BIGINT), 'miles_pct', {label})"
            )
    out = groups.selectExpr(*ids, f"explode(array({', '.join(rows)})) AS r").where("r.keep")
    return out.select(*ids, "r.type", "r.user_type", "r.user_cnt", "r.miles_pct")


def growth(activity: DataFrame, grain: str = "day", mode: str = "parity", strict_subtype: bool | None = None) -> DataFrame:
    """Long growth-accounting table for ``grain`` in ``mode``.

    ``parity`` has week-month pieces, and weekly and monthly tables that never
    report churned or resurrected users.  ``strict`` works per whole
    week (reported under the month of its Sunday) or month, counts users who
    leave for good as churned, and tests earned *and* redeemed in the
    sub-type (override with ``strict_subtype``).

    Count and miles labels are disjoint and group keys are unique, so no sum
    over their union is needed.
    """
    u = _units(grain, mode)
    groups = consolidated_groups(activity, grain, mode, strict_subtype)
    return _long_rows(groups, [*u.key_names, "trns_type", "trns_sub_type"], with_miles=True)


def growth_consolidated(activity: DataFrame, strict_subtype: bool = False) -> DataFrame:
    """Day-grain user counts carrying day, week and month keys (no miles)."""
    groups = consolidated_groups(activity, "day", "parity", strict_subtype)
    return consolidated_rows(_long_rows(groups, ["cal_day", "trns_type", "trns_sub_type"], with_miles=False))


def consolidated_rows(daily: DataFrame) -> DataFrame:
    """The consolidated table from the rows of a daily one (its miles rows are dropped)."""
    return daily.where(F.col("user_type").isin(*USER_TYPES)).selectExpr(
        "cal_day",
        f"{week_start_sql('cal_day')} AS cal_week",
        f"{month_start_sql('cal_day')} AS cal_month",
        "trns_type",
        "trns_sub_type",
        "type",
        "user_type",
        "user_cnt",
    )
