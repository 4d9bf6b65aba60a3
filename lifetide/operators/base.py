"""Base tables: calendar, first-touch user dimension, event facts, ordinals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def calendar(events: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Every date from the first to the last event date, both included.

    One global min/max (partial aggregates per task, one row to the driver
    side of the plan), then ``sequence`` + ``explode``: the output is bounded
    by the calendar span, never by the event count.  No events, or only NULL
    times, give no rows.
    """
    bounds = events.agg(F.expr(f"min(to_date({time_col})) AS lo"), F.expr(f"max(to_date({time_col})) AS hi"))
    return bounds.selectExpr("explode(sequence(lo, hi)) AS day")


def dim_users(events: DataFrame) -> DataFrame:
    """First-touch attributes per user: every event at the user's first
    instant (ties keep one row each, which ``min_by`` would collapse).

    ``rank() = 1`` over (user_id ORDER BY event_time), after dropping NULL
    users and times (ascending order would put NULL times first).  Catalyst
    turns the rank filter into a group limit that also runs *before* the
    shuffle (WindowGroupLimit, partial): each task keeps only its local
    first-instant rows per user, so one scan suffices, the shuffle carries
    at most a few rows per user and task instead of every event, and a user
    holding a third of all events arrives at its final task as a handful of
    rows.  Only events tied at the exact first instant are all kept, as the
    result requires.
    """
    first = F.rank().over(Window.partitionBy("user_id").orderBy("event_time"))
    return (
        events.where("user_id IS NOT NULL AND event_time IS NOT NULL")
        .select(
            "user_id",
            F.col("event_time").alias("first_event_time"),
            F.col("platform").alias("first_platform"),
            F.col("utm_source").alias("first_utm_source"),
            F.col("country").alias("first_country"),
            first.alias("_rank"),
        )
        .where("_rank = 1")
        .drop("_rank")
    )


def fact_events(events: DataFrame) -> DataFrame:
    """The five-column event fact (pure projection; pruned at the scan)."""
    return events.select("event_time", "user_id", "event_type", "transaction_category", "miles_amount")


#: Rows that one task at most numbers for a single (user, instant) run.
ORDINAL_CHUNK = 500_000
#: Events that one range of users and times holds about, and the most ranges.
ORDINAL_RANGE, ORDINAL_RANGES = 4_000_000, 4096


def event_ordinal(events: DataFrame) -> DataFrame:
    """Running count of each user's events in time order (``session_number``).

    Equal to ``row_number() over (partition by user_id order by event_time)``
    without sorting a user, or any share of one that grows with the data, in
    one task.  Events of one user at one instant are interchangeable in the
    result, so they are only counted:

    1. events per (user, instant), partially aggregated before the shuffle;
    2. events before each instant: a running sum within the minute (bounded
       by the clock: its microseconds) and one of minutes within the user
       (bounded by the calendar);
    3. each instant's run of numbers, cut into chunks that are dealt out
       before they are expanded.

    NULL users form one group; NULL times sort first, like ascending SQL
    order, and are one instant.  No job runs before the action, so a view of
    the result follows its events; ``event_ordinal_ranges`` has half the
    shuffles for events that stay as they are.
    """
    instants = events.groupBy("user_id", "event_time").agg(F.count(F.lit(1)).alias("_n"))
    # Non-null keys, so that the join below is a plain equality.
    keys = ["_u", "_un", "_m", "_tn"]
    keyed = instants.selectExpr(
        "coalesce(user_id, 0) AS _u",
        "user_id IS NULL AS _un",
        "coalesce(date_trunc('minute', event_time), TIMESTAMP_NTZ '1970-01-01 00:00:00') AS _m",
        "event_time IS NULL AS _tn",
        "event_time",
        "_n",
    )
    minute = Window.partitionBy(*keys)
    counted = keyed.select(
        "*", (F.sum("_n").over(minute.orderBy("event_time")) - F.col("_n")).alias("_before"), F.sum("_n").over(minute).alias("_total")
    )
    # A minute's last instant stands for the minute.
    minutes = counted.where("_before + _n = _total").select(*keys, "_total")
    in_user = Window.partitionBy("_u", "_un").orderBy(F.col("_tn").desc(), F.col("_m"))
    bases = minutes.select(*keys, (F.sum("_total").over(in_user) - F.col("_total")).alias("_base"))
    runs = counted.join(bases, keys).selectExpr(
        "CASE WHEN NOT _un THEN _u END AS user_id",
        "event_time",
        "_base + _before AS _from",
        "_n",
        f"explode(sequence(0L, (_n - 1) DIV {ORDINAL_CHUNK})) AS _chunk",
    )
    dealt = runs.repartition("user_id", "event_time", "_chunk")
    first = f"_chunk * {ORDINAL_CHUNK} + 1"
    return dealt.selectExpr(
        "user_id", "event_time", "_from", f"explode(sequence({first}, least(_n, {first} + {ORDINAL_CHUNK - 1}))) AS _i"
    ).selectExpr("user_id", "event_time", "_from + _i AS session_number")


def event_ordinal_ranges(events: DataFrame) -> DataFrame:
    """``event_ordinal`` as a distributed prefix sum, for stored events.

    Users and times are cut into ranges of about ``ORDINAL_RANGE`` events at
    sampled bounds, so a user with a third of all events is many ranges, each
    with its own numbers in one window.  What a user has before a range is a
    carried offset: only the user in whom a bound lies has one, so offsets are
    one number a range, found by one scan that counts those users' events by
    range.  Bounds and offsets (``ORDINAL_RANGES`` at most) are literals of the
    plan.  Counted instants are then shuffled twice (by instant, by range and
    user), with no join and no window over more than one range; runs longer
    than ``ORDINAL_CHUNK`` are dealt out before they are expanded.

    A table of less than one range (found by its count) needs no bounds, and
    one of less than a chunk no dealing out.
    """
    keys = events.select("user_id", "event_time")
    rows = keys.count()
    bounds = _ordinal_bounds(keys, rows)
    instants = keys.groupBy("user_id", "event_time").agg(F.count(F.lit(1)).alias("_n"))
    ranged = instants.withColumn("_range", F.expr(_range_sql(bounds)))
    line = Window.partitionBy("_range", "user_id").orderBy("event_time")
    runs = ranged.select(
        "user_id", "event_time", "_n",
        (F.sum("_n").over(line) - F.col("_n") + F.expr(_offset_sql(keys, bounds))).alias("_from"),
    )
    if rows > ORDINAL_CHUNK:
        runs = runs.withColumn("_chunk", F.expr(f"explode(sequence(0L, (_n - 1) DIV {ORDINAL_CHUNK}))")).repartition("user_id", "event_time", "_chunk")
    else:
        runs = runs.withColumn("_chunk", F.lit(0).cast("long"))
    first = f"_chunk * {ORDINAL_CHUNK} + 1"
    return runs.selectExpr(
        "user_id", "event_time", "_from", f"explode(sequence({first}, least(_n, {first} + {ORDINAL_CHUNK - 1}))) AS _i"
    ).selectExpr("user_id", "event_time", "_from + _i AS session_number")


#: A bound: a user (as ``_ORDINAL_USER``) and the time from which that user's
#: events are in the next range.
Bound = tuple[int, dt.datetime]
#: The order of users; the NULL one comes before all others.
_ORDINAL_USER = "coalesce(CAST(user_id AS DECIMAL(20, 0)), -9223372036854775809)"


def _ordinal_bounds(keys: DataFrame, rows: int) -> list[Bound]:
    """Bounds between ranges, in order, from a sample of the instants (16 a
    range) that is the same in every run.  A user's events without a time are
    one instant, before the user's others, and no bound."""
    ranges = min(ORDINAL_RANGES, rows // ORDINAL_RANGE + 1)
    if ranges == 1:
        return []
    share = max(1, rows // (16 * ranges))
    picked = F.pmod(F.xxhash64("user_id", "event_time"), F.lit(share)) == 0
    sample = keys.where(F.col("event_time").isNotNull() & picked).distinct().select(F.expr(_ORDINAL_USER).alias("u"), "event_time").collect()
    line = sorted((int(r["u"]), r["event_time"]) for r in sample)
    return sorted({line[i * len(line) // ranges] for i in range(1, ranges)}) if line else []


def _literal(values: list, kind: str) -> str:
    """An array of fixed values, made from one text when the plan is optimised."""
    return f"cast(split('{','.join(map(str, values))}', ',') AS array<{kind}>)"


def _range_sql(bounds: list[Bound]) -> str:
    """The number of bounds up to a row's user and time, by halving steps."""
    if not bounds:
        return "0"
    users, times = _literal([u for u, _ in bounds], "decimal(20,0)"), _literal([t.isoformat(" ") for _, t in bounds], "timestamp_ntz")
    steps = ", ".join(str(1 << i) for i in range(len(bounds).bit_length() - 1, -1, -1))
    at, user = "p + s - 1", _ORDINAL_USER
    passed = f"(get({users}, {at}) < {user} OR get({users}, {at}) = {user} AND get({times}, {at}) <= event_time)"
    return f"aggregate(array({steps}), 0, (p, s) -> CASE WHEN p + s <= {len(bounds)} AND {passed} THEN p + s ELSE p END)"


def _offset_sql(keys: DataFrame, bounds: list[Bound]) -> str:
    """What a row's user has in earlier ranges: the user of the bound before a
    range is the only one that can have any."""
    if not bounds:
        return "0L"
    users = sorted({u for u, _ in bounds})
    named = keys.select(F.expr(_ORDINAL_USER).alias("u"), F.expr(_range_sql(bounds)).alias("range"))
    held = named.where(f"u IN ({', '.join(map(str, users))})").groupBy("u", "range").count().collect()
    counts = {(int(r["u"]), r["range"]): r["count"] for r in held}
    total, before = dict.fromkeys(users, 0), []
    for place, (u, _) in enumerate(bounds):
        total[u] += counts.get((u, place), 0)
        before.append(total[u])
    owner, offset = f"get({_literal([u for u, _ in bounds], 'decimal(20,0)')}, _range - 1)", f"get({_literal(before, 'bigint')}, _range - 1)"
    return f"CASE WHEN {_ORDINAL_USER} = {owner} THEN {offset} ELSE 0L END"
