"""DuckDB SQL for every registered query: a brute-force specification.

Each query is written the plain, quadratic way, independently of the Spark
operators: the user x day grid is a range join of the calendar with every
user's first..last active day; "previous day active" is a self-join on the
day before; status counts are ``COUNT(DISTINCT user_id) FILTER (...)`` per
group; the long format is a ``UNION ALL`` per label; week / month pieces are
numbered per user; cohorts come from a per-user ``min``.  None of the Spark
shortcuts (sequence-built spine, gap sweep, plain counts, days-first roll-up)
is used here, so the differential tests check them against the definition.

DuckDB dialect notes: dates are casts of timestamps, Sunday weeks are
``d - dayofweek(d)`` (0 = Sunday), month truncation returns a TIMESTAMP and
is cast back, SUM(BIGINT) is HUGEINT and is cast back, ascending NULLs sort
last unless told otherwise.

Fixed values (must be spelled exactly like this for result parity): the event
types, the transaction types and sub-types, the user types and row kinds that
appear below as string literals.
"""

from __future__ import annotations

# -- sources ----------------------------------------------------------------

EVENTS_SOURCE = """
src_raw AS (
  SELECT
    ts AS event_time,
    user_id,
    CASE event_type
      WHEN 'purchase' THEN 'miles_earned'
      WHEN 'signup' THEN 'miles_redeemed'
      WHEN 'view' THEN 'reward_search'
      ELSE event_type
    END AS event_type,
    value AS amount,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
event_stream AS (
  SELECT
    event_time,
    user_id,
    event_type,
    CASE WHEN event_type IN ('miles_earned', 'miles_redeemed') THEN 'miles' ELSE 'engagement' END AS transaction_category,
    CASE WHEN event_type IN ('miles_earned', 'miles_redeemed') THEN CAST(floor(amount) AS BIGINT) END AS miles_amount,
    CASE k % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' WHEN 2 THEN 'web' END AS platform,
    CASE k % 4 WHEN 0 THEN 'organic' WHEN 1 THEN 'email' WHEN 2 THEN 'ads' WHEN 3 THEN 'referral' END AS utm_source,
    CASE k % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'SG' WHEN 2 THEN 'PH' WHEN 3 THEN 'JP' WHEN 4 THEN 'DE' END AS country
  FROM src_raw
)"""

ORDERS_SOURCE = """
src_raw AS (
  SELECT
    o_orderdate AS event_time,
    o_custkey AS user_id,
    CASE o_orderstatus
      WHEN 'F' THEN 'miles_earned'
      WHEN 'P' THEN 'miles_redeemed'
      WHEN 'O' THEN 'reward_search'
    END AS event_type,
    o_totalprice AS amount,
    o_orderpriority AS platform,
    'orders-' || o_orderstatus AS utm_source,
    CASE o_custkey % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'SG' WHEN 2 THEN 'PH' WHEN 3 THEN 'JP' WHEN 4 THEN 'DE' END AS country
  FROM orders
),
event_stream AS (
  SELECT
    event_time,
    user_id,
    event_type,
    CASE WHEN event_type IN ('miles_earned', 'miles_redeemed') THEN 'miles' ELSE 'engagement' END AS transaction_category,
    CASE WHEN event_type IN ('miles_earned', 'miles_redeemed') THEN CAST(floor(amount) AS BIGINT) END AS miles_amount,
    platform,
    utm_source,
    country
  FROM src_raw
)"""

SOURCES = {"events": EVENTS_SOURCE, "orders": ORDERS_SOURCE}



MILES = "('miles_earned', 'miles_redeemed')"
GRAIN_COHORT = {"day": "cohort_date", "week": "cohort_week_date", "month": "cohort_month_date"}


def _week(d: str) -> str:
    return f"({d} - CAST(dayofweek({d}) AS INTEGER))"


def _month(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# -- shared building blocks --------------------------------------------------

DAY_MEASURES = f"""
day_measures AS (
  SELECT
    CAST(event_time AS DATE) AS day,
    user_id,
    count(event_time) AS trns_activity,
    count(event_time) FILTER (WHERE event_type IS NULL OR event_type NOT IN {MILES}) AS activity,
    count(event_time) FILTER (WHERE event_type IN {MILES}) AS trns,
    CAST(sum(CASE WHEN event_type = 'miles_earned' THEN miles_amount ELSE 0 END) AS BIGINT) AS miles_earned,
    CAST(sum(CASE WHEN event_type = 'miles_redeemed' THEN miles_amount ELSE 0 END) AS BIGINT) AS miles_redeemed
  FROM event_stream
  GROUP BY 1, 2
)"""

CALENDAR_DAYS = """
calendar_days AS (
  SELECT CAST(x AS DATE) AS day
  FROM (
    SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS x
    FROM (SELECT min(CAST(event_time AS DATE)) AS lo, max(CAST(event_time AS DATE)) AS hi FROM event_stream) bounds
  ) series
)"""

# Every calendar day of every user's active span, its measures and whether
# the calendar day before was active.
SPINE = """
user_span AS (
  SELECT user_id, min(day) AS first_day, max(day) AS last_day
  FROM day_measures
  WHERE user_id IS NOT NULL AND day IS NOT NULL
  GROUP BY user_id
),
spine AS (
  SELECT
    s.user_id,
    c.day AS cal_day,
    m.day AS trns_day,
    p.day AS prev_day,
    c.day = s.first_day AS is_new_user,
    s.first_day AS first_seen,
    m.trns_activity, m.activity, m.trns, m.miles_earned, m.miles_redeemed
  FROM user_span s
  JOIN calendar_days c ON c.day BETWEEN s.first_day AND s.last_day
  LEFT JOIN day_measures m ON m.user_id = s.user_id AND m.day = c.day
  LEFT JOIN day_measures p ON p.user_id = s.user_id AND p.day = c.day - 1
)"""

# Strict periods go on to the calendar's end: a user who leaves is idle there.
SPINE_TO_END = SPINE.replace("AND s.last_day", "AND (SELECT max(day) FROM calendar_days)")


def _type_case(a: str, t: str, churn: str) -> str:
    return (
        f"CASE WHEN {a} > 0 AND {t} > 0 THEN 'Miles & Engagement' "
        f"WHEN {a} > 0 AND {t} = 0 THEN 'Engagement' "
        f"WHEN {a} = 0 AND {t} > 0 THEN 'Miles' "
        f"WHEN {churn} THEN 'Churned' ELSE 'No Activity' END"
    )


def _sub_type_case(a: str, t: str, e: str, r: str, churn: str, strict: bool) -> str:
    """Decision table by activity class.  Without ``strict`` the
    earned-and-redeemed test looks at the redeemed amount only."""
    other = f"CASE WHEN {churn} THEN 'Churned' ELSE 'No Activity' END"
    both = f"{e} <> 0 AND {r} <> 0" if strict else f"{r} <> 0"
    miles = (
        f"CASE WHEN {both} THEN 'Miles Earned & Redeemed' WHEN {e} = 0 THEN 'Miles Redemption Only' "
        f"WHEN {r} = 0 THEN 'Miles Earned Only' ELSE {other} END"
    )
    mixed = (
        f"CASE WHEN {both} THEN 'Engagement & Earn & Redeem' WHEN {e} = 0 THEN 'Engagement & Miles Redemption' "
        f"WHEN {r} = 0 THEN 'Engagement & Miles Earned' ELSE {other} END"
    )
    return (
        f"CASE WHEN {a} > 0 AND {t} = 0 THEN 'Engagement' "
        f"WHEN {a} = 0 AND {t} > 0 THEN {miles} "
        f"WHEN {a} > 0 AND {t} > 0 THEN {mixed} "
        f"ELSE {other} END"
    )


def _labels(churn: str, strict: bool) -> str:
    return (
        f"{_type_case('activity', 'trns', churn)} AS trns_type, "
        f"{_sub_type_case('activity', 'trns', 'miles_earned', 'miles_redeemed', churn, strict)} AS trns_sub_type"
    )


# Spine rows with the three facts every status is made of, and the labels.
LABELLED_DAYS = f"""
labelled_days AS (
  SELECT
    *,
    trns_day IS NOT NULL AS is_active,
    prev_day IS NOT NULL AS was_active,
    {_labels("trns_day IS NULL AND prev_day IS NOT NULL", False)}
  FROM spine
)"""


def _status_counts(src: str, keys: list[str], select_keys: list[str]) -> str:
    """Distinct users per status in each (period, type, sub-type) group."""
    return f"""
status_groups AS (
  SELECT
    {", ".join(select_keys)}, trns_type, trns_sub_type,
    count(DISTINCT user_id) FILTER (WHERE is_new_user) AS new_users,
    count(DISTINCT user_id) FILTER (WHERE NOT is_new_user AND is_active AND was_active) AS retained,
    count(DISTINCT user_id) FILTER (WHERE NOT is_new_user AND is_active AND NOT was_active) AS resurrected,
    count(DISTINCT user_id) FILTER (WHERE NOT is_new_user AND NOT is_active AND was_active) AS churned_users,
    count(DISTINCT user_id) FILTER (WHERE is_active) AS active,
    CAST(sum(miles_earned) AS BIGINT) AS miles_earned,
    CAST(sum(miles_redeemed) AS BIGINT) AS miles_redeemed
  FROM {src}
  GROUP BY {", ".join(keys)}, trns_type, trns_sub_type
)"""


def _long_rows(keys: list[str], with_miles: bool) -> str:
    """One SELECT per output label over ``status_groups``."""
    k = ", ".join(keys)

    def row(kind: str, label: str, cnt: str, miles: str, where: str) -> str:
        return (
            f"SELECT {k}, trns_type, trns_sub_type, '{kind}' AS type, '{label}' AS user_type, "
            f"CAST({cnt} AS BIGINT) AS user_cnt, CAST({miles} AS BIGINT) AS miles_pct "
            f"FROM status_groups WHERE {where}"
        )

    not_churn = "trns_type <> 'Churned'"
    is_churn = "trns_type = 'Churned'"
    parts = [row("BREAKDOWN", lab, lab, "0", not_churn) for lab in ("new_users", "retained", "resurrected", "active")]
    parts.append(row("TOTAL", "tot_churned", "churned_users", "0", is_churn))
    parts.append(row("BREAKDOWN", "churned", "-churned_users", "0", is_churn))
    if with_miles:
        for m in ("miles_earned", "miles_redeemed"):
            parts.append(row("TOTAL", m, "0", m, f"trns_type NOT IN ('Churned', 'No Activity') AND {m} IS NOT NULL"))
    return "\nUNION ALL\n".join(parts)


def _spine_ctes(source: str, to_end: bool = False) -> list[str]:
    return [SOURCES[source], DAY_MEASURES, CALENDAR_DAYS, SPINE_TO_END if to_end else SPINE]


# -- query builders --------------------------------------------------------------


def calendar_sql(source: str) -> str:
    return _with(SOURCES[source], CALENDAR_DAYS) + "\nSELECT day FROM calendar_days"


def dim_users_sql(source: str) -> str:
    return _with(SOURCES[source]) + """
SELECT e.user_id, e.event_time AS first_event_time, e.platform AS first_platform,
       e.utm_source AS first_utm_source, e.country AS first_country
FROM event_stream e
WHERE e.event_time = (SELECT min(x.event_time) FROM event_stream x WHERE x.user_id = e.user_id)"""


def fct_events_sql(source: str) -> str:
    return _with(SOURCES[source]) + (
        "\nSELECT event_time, user_id, event_type, transaction_category, miles_amount FROM event_stream"
    )


def event_stream_sql(source: str) -> str:
    return _with(SOURCES[source]) + (
        "\nSELECT event_time, user_id, event_type, transaction_category, miles_amount, platform, utm_source, country "
        "FROM event_stream"
    )


def event_ordinal_sql(source: str) -> str:
    return _with(SOURCES[source]) + """
SELECT user_id, event_time,
       row_number() OVER (PARTITION BY user_id ORDER BY event_time ASC NULLS FIRST) AS session_number
FROM event_stream"""


def user_day_activity_sql(source: str) -> str:
    return _with(SOURCES[source], DAY_MEASURES) + "\nSELECT * FROM day_measures"


def user_day_spine_sql(source: str) -> str:
    return _with(*_spine_ctes(source)) + """
SELECT user_id, cal_day, trns_day, prev_day, is_new_user, first_seen,
       trns_activity, activity, trns, miles_earned, miles_redeemed
FROM spine"""


def user_day_status_sql(source: str) -> str:
    one = "CAST(1 AS BIGINT)"
    return _with(*_spine_ctes(source), LABELLED_DAYS) + f"""
SELECT
  user_id, {_week('cal_day')} AS cal_week, {_month('cal_day')} AS cal_month, cal_day, trns_day, prev_day,
  CASE WHEN is_new_user THEN {one} END AS new_user,
  CASE WHEN is_active THEN {one} END AS active,
  CASE WHEN NOT is_new_user AND is_active AND was_active THEN {one} END AS retained,
  CASE WHEN NOT is_new_user AND is_active AND NOT was_active THEN {one} END AS resurrected,
  CASE WHEN NOT is_new_user AND NOT is_active AND was_active THEN {one} END AS churned,
  trns_type, trns_sub_type,
  trns_activity, activity, trns, miles_earned, miles_redeemed
FROM labelled_days"""


def growth_daily_sql(source: str) -> str:
    keys = ["cal_day", "cal_month"]
    return _with(
        *_spine_ctes(source),
        LABELLED_DAYS,
        _status_counts("labelled_days", ["cal_day"], ["cal_day", f"{_month('cal_day')} AS cal_month"]),
    ) + "\n" + _long_rows(keys, with_miles=True)


def growth_consolidated_sql(source: str) -> str:
    counts = _long_rows(["cal_day"], with_miles=False)
    return _with(
        *_spine_ctes(source),
        LABELLED_DAYS,
        _status_counts("labelled_days", ["cal_day"], ["cal_day"]),
    ) + f"""
SELECT cal_day, {_week('cal_day')} AS cal_week, {_month('cal_day')} AS cal_month,
       trns_type, trns_sub_type, type, user_type, user_cnt
FROM ({counts}) c"""


def growth_period_sql(source: str, grain: str, strict: bool = False) -> str:
    """Week / month growth from per-user period pieces of the day grid.

    ``strict=False``: a week is split at month ends; a piece counts as new
    when it holds the user's first day, and an active piece has a known
    predecessor when the user has a piece before it.  Strict: whole weeks
    under the month of their Sunday, or months, from the user's first day to
    the calendar's end; the predecessor is the previous calendar period, known
    when the user was active in it.
    """
    if grain == "week":
        period = _week("cal_day")
        month = _month(period) if strict else _month("cal_day")
        keys = ["cal_week", "cal_month"]
        piece_keys = f"{period} AS cal_week, {month} AS cal_month"
        period_col = "cal_week"
        step = "INTERVAL 7 DAY"
    elif grain == "month":
        keys = ["cal_month"]
        piece_keys = f"{_month('cal_day')} AS cal_month"
        period_col = "cal_month"
        step = "INTERVAL 1 MONTH"
    else:
        raise ValueError(grain)
    pieces = f"""
pieces AS (
  SELECT
    user_id, {piece_keys},
    min(cal_day) AS piece_day,
    bool_or(trns_day IS NOT NULL) AS is_active,
    bool_or(is_new_user) AS is_new_user,
    CAST(sum(trns_activity) AS BIGINT) AS trns_activity,
    CAST(sum(activity) AS BIGINT) AS activity,
    CAST(sum(trns) AS BIGINT) AS trns,
    CAST(sum(miles_earned) AS BIGINT) AS miles_earned,
    CAST(sum(miles_redeemed) AS BIGINT) AS miles_redeemed
  FROM spine
  GROUP BY ALL
)"""
    if strict:
        known = f"""
with_prev AS (
  SELECT p.*, coalesce(q.is_active, FALSE) AS was_active
  FROM pieces p
  LEFT JOIN pieces q
    ON q.user_id = p.user_id AND q.{period_col} = CAST(p.{period_col} - {step} AS DATE)
)"""
    else:
        known = f"""
with_prev AS (
  SELECT p.*, p.is_active AND q.piece_day IS NOT NULL AS was_active
  FROM pieces p
  LEFT JOIN (SELECT user_id, min(piece_day) AS piece_day FROM pieces GROUP BY user_id) q
    ON q.user_id = p.user_id AND q.piece_day < p.piece_day
)"""
    labelled = f"""
labelled_pieces AS (
  SELECT *, {_labels("NOT is_active AND was_active", strict)}
  FROM with_prev
)"""
    return _with(
        *_spine_ctes(source, strict), pieces, known, labelled, _status_counts("labelled_pieces", keys, keys)
    ) + "\n" + _long_rows(keys, with_miles=True)


def _triangle_ctes(grain: str) -> str:
    day = "CAST(event_time AS DATE)"
    period = {"day": day, "week": _week(day), "month": _month(day)}[grain]
    offset = {
        "day": "date_diff('day', r.cohort, r.period)",
        "week": "date_diff('day', r.cohort, r.period) // 7",
        "month": "(year(r.period) - year(r.cohort)) * 12 + (month(r.period) - month(r.cohort))",
    }[grain]
    return f"""
user_periods AS (
  SELECT DISTINCT user_id, {period} AS period FROM event_stream WHERE user_id IS NOT NULL
),
first_period AS (
  SELECT user_id, min(period) AS cohort FROM user_periods GROUP BY user_id
),
period_users AS (
  SELECT f.cohort, u.period, count(DISTINCT u.user_id) AS users
  FROM user_periods u JOIN first_period f ON f.user_id = u.user_id
  GROUP BY f.cohort, u.period
),
triangle AS (
  SELECT
    {_month('r.period')} AS cal_month,
    {_month('r.cohort')} AS cohort_ref_month,
    r.cohort AS {GRAIN_COHORT[grain]},
    CAST({offset} AS BIGINT) AS period_offset,
    r.users,
    z.users AS cohort_size,
    CASE WHEN z.users = 0 THEN NULL ELSE CAST(r.users AS DOUBLE) / z.users END AS retention_rate
  FROM period_users r
  JOIN period_users z ON z.cohort = r.cohort AND z.period = z.cohort
)"""


def triangle_sql(source: str, grain: str) -> str:
    return _with(SOURCES[source], _triangle_ctes(grain)) + "\nSELECT * FROM triangle"


def cohort_matrix_sql(source: str, grain: str) -> str:
    """Every cohort x every period from it to the last one, by a range join."""
    cohort = GRAIN_COHORT[grain]
    offset = {
        "day": "date_diff('day', c.cohort, p.period)",
        "week": "date_diff('day', c.cohort, p.period) // 7",
        "month": "(year(p.period) - year(c.cohort)) * 12 + (month(p.period) - month(c.cohort))",
    }[grain]
    step = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH"}[grain]
    return _with(SOURCES[source], _triangle_ctes(grain)) + f""",
bounds AS (SELECT min(period) AS lo, max(period) AS hi FROM user_periods),
periods AS (SELECT CAST(unnest(generate_series(lo, hi, {step})) AS DATE) AS period FROM bounds WHERE lo IS NOT NULL),
cohorts AS (SELECT {cohort} AS cohort, max(cohort_size) AS cohort_size FROM triangle GROUP BY {cohort})
SELECT c.cohort AS {cohort}, CAST({offset} AS BIGINT) AS period_offset, coalesce(t.users, 0) AS users,
       c.cohort_size, t.retention_rate
FROM cohorts c
JOIN periods p ON p.period >= c.cohort
LEFT JOIN triangle t ON t.{cohort} = c.cohort AND t.period_offset = {offset}"""


def cohort_matrix_wide_sql(source: str, grain: str) -> str:
    """The cells of each cohort gathered into lists, in offset order."""
    cohort = GRAIN_COHORT[grain]
    share = "coalesce(CAST(CAST(floor(retention_rate * 1000000) AS BIGINT) AS VARCHAR), '')"
    return f"""SELECT {cohort}, max(cohort_size) AS cohort_size,
  array_to_string(list(CAST(users AS VARCHAR) ORDER BY period_offset), ',') AS users,
  array_to_string(list({share} ORDER BY period_offset), ',') AS retention_rates
FROM ({cohort_matrix_sql(source, grain)}) cells
GROUP BY {cohort}"""


def status_report_sql(source: str, grain: str) -> str:
    """Wide report over the long growth table of the grain."""
    growth_sql = growth_daily_sql(source) if grain == "day" else growth_period_sql(source, grain)
    k = {"day": "cal_day, cal_month", "week": "cal_week, cal_month", "month": "cal_month"}[grain]
    types = ["new_users", "retained", "resurrected", "tot_churned", "churned", "active"]
    cols = ",\n  ".join(f"CAST(SUM(CASE WHEN user_type = '{t}' THEN user_cnt END) AS BIGINT) AS {t}" for t in types)
    return f"SELECT {k},\n  {cols}\nFROM ({growth_sql}) g\nGROUP BY {k}"


def transaction_breakdown_sql(source: str, grain: str) -> str:
    """Active users per period and transaction type (type from the period sums)."""
    period = {"day": "day", "week": _week("day"), "month": _month("day")}[grain]
    return _with(SOURCES[source], DAY_MEASURES) + f"""
, per_period AS (
  SELECT {period} AS period_start, user_id,
    CAST(sum(trns_activity) AS BIGINT) AS trns_activity,
    CAST(sum(activity) AS BIGINT) AS activity,
    CAST(sum(trns) AS BIGINT) AS trns,
    CAST(sum(miles_earned) AS BIGINT) AS miles_earned,
    CAST(sum(miles_redeemed) AS BIGINT) AS miles_redeemed
  FROM day_measures
  WHERE user_id IS NOT NULL AND day IS NOT NULL
  GROUP BY 1, 2
),
labelled AS (
  SELECT *, {_type_case('activity', 'trns', 'FALSE')} AS trns_type FROM per_period
)
SELECT period_start, trns_type,
       count(*) AS users,
       CAST(sum(trns_activity) AS BIGINT) AS events,
       CAST(sum(miles_earned) AS BIGINT) AS miles_earned,
       CAST(sum(miles_redeemed) AS BIGINT) AS miles_redeemed
FROM labelled
WHERE trns_type IN ('Engagement', 'Miles', 'Miles & Engagement')
GROUP BY period_start, trns_type"""
