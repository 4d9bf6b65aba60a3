"""Per user-day measures and the gap-filled user x day spine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lifetide.functions.labels import MILES_EARNED, MILES_REDEEMED

MEASURES = ["trns_activity", "activity", "trns", "miles_earned", "miles_redeemed"]

_IS_MILES = f"event_type IN ('{MILES_EARNED}', '{MILES_REDEEMED}')"
_DAY_MEASURES = [
    "count(event_time) AS trns_activity",
    f"count(CASE WHEN {_IS_MILES} THEN NULL ELSE event_time END) AS activity",
    f"count(CASE WHEN {_IS_MILES} THEN event_time END) AS trns",
    f"sum(CASE WHEN event_type = '{MILES_EARNED}' THEN miles_amount ELSE 0 END) AS miles_earned",
    f"sum(CASE WHEN event_type = '{MILES_REDEEMED}' THEN miles_amount ELSE 0 END) AS miles_redeemed",
]


def measure_types(df: DataFrame) -> dict[str, str]:
    """SQL types of the measures: BIGINT, or a decimal for fractional miles.
    Sums are cast back to them, so every model keeps one type."""
    return {m: df.schema[m].dataType.simpleString() for m in MEASURES}


def user_day_activity(events: DataFrame) -> DataFrame:
    """Five measures per (day, user).

    trns_activity counts timed events; activity counts the non-miles ones
    (a NULL event type counts as engagement); trns counts the miles ones;
    miles_earned / miles_redeemed sum the amounts of their type (other
    events add 0, NULL amounts are skipped, all-NULL gives NULL).

    Partial aggregation runs before the shuffle, so a hot user is reduced to
    one row per day per task.  NULL users and days are kept as groups; the
    spine and the cohort operators drop them.
    """
    return events.groupBy(F.expr("to_date(event_time)").alias("day"), "user_id").agg(
        *[F.expr(e) for e in _DAY_MEASURES]
    )


def user_days(activity: DataFrame) -> DataFrame:
    """``activity`` with each row's previous and next active day and the
    user's first one (``prev_active``, ``next_active``, ``first_seen``).

    One window over the user's days: after the day aggregation a user has at
    most one row per calendar day (and one without), so no partition outgrows
    the calendar span however many events a user has.  Rows without a day
    come first and give the following day no predecessor.  A table that has
    the columns already (``plans.pipeline`` stores one) is returned as it is.
    """
    if "prev_active" in activity.columns:
        return activity
    w = Window.partitionBy("user_id").orderBy("day")
    return activity.select(
        "user_id",
        "day",
        *MEASURES,
        F.lag("day").over(w).alias("prev_active"),
        F.lead("day").over(w).alias("next_active"),
        F.min("day").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("first_seen"),
    )


def active_days(activity: DataFrame) -> DataFrame:
    """``user_days`` of known users on known days."""
    return user_days(activity.where("user_id IS NOT NULL AND day IS NOT NULL"))


def user_day_spine(activity: DataFrame) -> DataFrame:
    """Every day from each user's first to last active day (growth_transactions).

    Columns: user_id, cal_day, trns_day (cal_day when active), prev_day
    (the previous *calendar* day when it was active), is_new_user, first_seen
    and the five measures (NULL on idle days).

    Instead of joining a calendar to every user (a theta join) and back to
    the measures, each active day emits itself plus the idle days since the
    previous active day: one ``sequence``/``explode`` per active day, so the
    cost is the output size.  ``prev_day`` is then the previous active day
    exactly when it is the day before.
    """
    # Adaptive execution sizes tasks by the active days, which are small for the days they give; a fixed number is kept.
    tasks = int(activity.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spine = active_days(activity).repartition(tasks, "user_id", "day").selectExpr(
        "*", "explode(sequence(coalesce(date_add(prev_active, 1), day), day)) AS cal_day"
    )
    return spine.selectExpr(
        "user_id",
        "cal_day",
        "CASE WHEN cal_day = day THEN day END AS trns_day",
        "CASE WHEN cal_day = date_add(prev_active, 1) THEN prev_active END AS prev_day",
        "cal_day = first_seen AS is_new_user",
        "first_seen",
        *[f"CASE WHEN cal_day = day THEN {m} END AS {m}" for m in MEASURES],
    )


#: Columns of a run of days that are the same on each of its days.
_RUN_COLUMNS = ["trns_day", "prev_day", "is_new_user", "first_seen", *MEASURES]


def user_day_runs(activity: DataFrame) -> DataFrame:
    """The spine as runs of days that are alike: ``user_id, from_day, to_day``
    and the spine's other columns.

    An active day is a run of its own, the first idle day after it another
    (only that one has a ``prev_day``, so only it can be churn), and all
    further idle days up to the next active one are one run.  So there are at
    most three rows per active day however long the gaps are, while the spine
    has users x calendar span.  ``expand_runs`` gives the spine.
    """
    idle = ", ".join(f"'{m}', CAST(NULL AS {t})" for m, t in measure_types(activity).items())
    same = ", ".join(f"'{m}', {m}" for m in MEASURES)
    date = "CAST(NULL AS DATE)"

    def run(start: str, end: str, trns: str, prev: str, new: str, measures: str) -> str:
        return (
            f"named_struct('from_day', {start}, 'to_day', {end}, 'trns_day', {trns}, 'prev_day', {prev}, "
            f"'is_new_user', {new}, 'first_seen', first_seen, {measures})"
        )

    before = "CASE WHEN datediff(day, prev_active) = 1 THEN prev_active END"
    runs = [
        run("day", "day", "day", before, "day = first_seen", same),
        f"CASE WHEN datediff(day, prev_active) > 1 THEN {run('date_add(prev_active, 1)', 'date_add(prev_active, 1)', date, 'prev_active', 'false', idle)} END",
        f"CASE WHEN datediff(day, prev_active) > 2 THEN {run('date_add(prev_active, 2)', 'date_sub(day, 1)', date, date, 'false', idle)} END",
    ]
    return active_days(activity).selectExpr("user_id", f"explode(array({', '.join(runs)})) AS r").where("r IS NOT NULL").select("user_id", "r.*")


def expand_runs(runs: DataFrame) -> DataFrame:
    """The spine (``user_day_spine``) from ``user_day_runs``, one row a day."""
    return runs.selectExpr("user_id", "explode(sequence(from_day, to_day)) AS cal_day", *_RUN_COLUMNS)
