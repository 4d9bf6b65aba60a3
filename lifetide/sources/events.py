"""The ``event_stream`` source and adapters from the test tables.

The logical source has eight columns (``EVENT_SCHEMA``).  Two adapters map
the driver tables onto it; the mapping is arbitrary but fixed, and the DuckDB
oracle in ``lifetide.plans.oracle`` applies the very same one.

Only the columns an adapter needs are read, so Parquet column pruning reaches
the scan; no filter is applied here, so every row of the table flows on.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lifetide.functions.labels import MILES_EARNED, MILES_REDEEMED, REWARD_SEARCH

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("transaction_category", T.StringType(), True),
        T.StructField("miles_amount", T.LongType(), True),
        T.StructField("platform", T.StringType(), True),
        T.StructField("utm_source", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
    ]
)
EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]

# Fixed values of the test-table adapters (shared with the SQL oracle).
PLATFORMS = ["ios", "android", "web"]
UTM_SOURCES = ["organic", "email", "ads", "referral"]
COUNTRIES = ["US", "SG", "PH", "JP", "DE"]
EVENTS_TYPE_MAP = {"purchase": MILES_EARNED, "signup": MILES_REDEEMED, "view": REWARD_SEARCH}
ORDERS_TYPE_MAP = {"F": MILES_EARNED, "P": MILES_REDEEMED, "O": REWARD_SEARCH}
MILES_CATEGORY = "miles"
ENGAGEMENT_CATEGORY = "engagement"


#: Columns without which no model can be built; the others default to NULL.
REQUIRED_COLUMNS = ["event_time", "user_id", "event_type"]
#: Kinds of value that a source column may be stored as; text is parsed.
ACCEPTED_TYPES = {
    "event_time": (T.TimestampType, T.TimestampNTZType, T.DateType, T.StringType),
    "user_id": (T.IntegralType, T.DecimalType, T.StringType),
    "miles_amount": (T.NumericType, T.StringType, T.NullType),
}
OTHER_TYPES = (T.StringType, T.NumericType, T.BooleanType, T.NullType)
#: Digits after the point kept of amounts that come as floating point or text.
FRACTION_DIGITS = 9


def _utc(column: str) -> str:
    """UTC wall clock of an instant, whatever the session's time zone."""
    seconds = f"CAST(CAST(unix_micros(`{column}`) AS DECIMAL(24, 6)) / 1000000 AS DECIMAL(18, 6))"
    return f"TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})"


def _checked(column: str, value: str) -> str:
    """``value``, an expression that is NULL where it fails; fails the query
    there instead of losing the row's value."""
    message = f"concat('{column}: malformed value ', `{column}`)"
    return f"CASE WHEN `{column}` IS NOT NULL AND {value} IS NULL THEN raise_error({message}) ELSE {value} END"


def _time(column: str, kind: T.DataType) -> str:
    if isinstance(kind, T.TimestampType):
        return _utc(column)
    if isinstance(kind, T.StringType):
        # Text that names a zone is an instant; other text is UTC wall clock.
        zone = f"`{column}` RLIKE ':[0-9.]+ ?(Z|UTC|[+-][0-9]{{2}}:?[0-9]{{2}})$'"
        instant = f"to_utc_timestamp(try_cast(`{column}` AS TIMESTAMP), current_timezone())"
        return _checked(column, f"CASE WHEN {zone} THEN CAST({instant} AS TIMESTAMP_NTZ) ELSE try_cast(`{column}` AS TIMESTAMP_NTZ) END")
    return f"CAST(`{column}` AS TIMESTAMP_NTZ)"


def _amount(column: str, kind: T.DataType) -> str:
    """Whole amounts stay BIGINT; others are exact decimals."""
    if isinstance(kind, T.IntegralType):
        return f"CAST(`{column}` AS BIGINT)"
    digits = kind.scale if isinstance(kind, T.DecimalType) else FRACTION_DIGITS
    if isinstance(kind, T.StringType):
        return _checked(column, f"try_cast(`{column}` AS DECIMAL(38, {digits}))")
    return f"CAST(`{column}` AS {'BIGINT' if digits == 0 else f'DECIMAL(38, {digits})'})"


def check_event_schema(schema: T.StructType) -> None:
    """Raise one error that names every required column that is missing and
    every source column whose type cannot be read as it should be."""
    names = schema.fieldNames()
    faults = [f"required column {c} is missing" for c in REQUIRED_COLUMNS if c not in names]
    for c in EVENT_COLUMNS:
        if c in names and not isinstance(kind := schema[c].dataType, ACCEPTED_TYPES.get(c, OTHER_TYPES)):
            faults.append(f"column {c} is {kind.simpleString()}")
    if faults:
        raise ValueError(f"not an event stream: {'; '.join(faults)} (columns: {names})")


def conform_events(df: DataFrame) -> DataFrame:
    """Project any DataFrame carrying the source columns onto the eight
    columns of ``EVENT_SCHEMA``.

    Instants (TIMESTAMP) become UTC wall clock whatever the session's time
    zone.  ``miles_amount`` is BIGINT for whole-number types and an exact
    DECIMAL for others.  Missing attributes are NULL; a missing required
    column is an error, and so is text that does not parse."""
    check_event_schema(df.schema)
    cols = []
    for field in EVENT_SCHEMA.fields:
        if field.name not in df.columns:
            cols.append(f"CAST(NULL AS {field.dataType.simpleString()}) AS {field.name}")
            continue
        kind = df.schema[field.name].dataType
        if field.name == "event_time":
            value = _time(field.name, kind)
        elif field.name == "miles_amount":
            value = _amount(field.name, kind)
        elif field.name == "user_id" and isinstance(kind, T.StringType):
            value = _checked(field.name, f"try_cast(`{field.name}` AS BIGINT)")
        else:
            value = f"CAST(`{field.name}` AS {field.dataType.simpleString()})"
        cols.append(f"{value} AS {field.name}")
    return df.selectExpr(*cols)


def read_event_stream(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Read a stored ``event_stream`` table in any Spark batch format.

    Self-describing formats (parquet, orc, ...) keep their stored types.  CSV
    columns are matched by the header's names and JSON fields by theirs, both
    as text, so a malformed value is an error and never NULL.  ``options`` go
    to the reader (for JSON, ``samplingRatio`` shortens the pass that finds
    the fields)."""
    if fmt == "csv":
        options = {"header": "true", "mode": "FAILFAST"} | options
    elif fmt == "json":
        options = {"primitivesAsString": "true", "mode": "FAILFAST"} | options
    return conform_events(spark.read.format(fmt).options(**options).load(path))


def read_event_table(spark: SparkSession, name: str) -> DataFrame:
    """Read the event stream from a table or view of the session catalog.

    The schema is checked by the catalog's entry, before any file is read, and
    columns and filters that a model does not need are pruned at the scan as
    for files."""
    return conform_events(spark.table(name))


def _case_index(expr: str, values: list[str]) -> str:
    """``values[expr]`` for a 0-based integer expression; NULL gives NULL."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


def _case_map(expr: str, mapping: dict[str, str], keep_other: bool) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {expr} {whens}" + (f" ELSE {expr} END" if keep_other else " END")


_IS_MILES = f"event_type IN ('{MILES_EARNED}', '{MILES_REDEEMED}')"
_MILES_COLUMNS = [
    f"CASE WHEN {_IS_MILES} THEN '{MILES_CATEGORY}' ELSE '{ENGAGEMENT_CATEGORY}' END AS transaction_category",
    f"CASE WHEN {_IS_MILES} THEN CAST(floor(_amount) AS BIGINT) END AS miles_amount",
]


#: Per test table: the columns read from it, and the source columns made of them.
ADAPTERS: dict[str, tuple[list[str], list[str]]] = {
    "events": (
        [
            "CAST(ts AS TIMESTAMP_NTZ) AS event_time",
            "CAST(user_id AS BIGINT) AS user_id",
            f"{_case_map('event_type', EVENTS_TYPE_MAP, keep_other=True)} AS event_type",
            "value AS _amount",
            "CAST(get_json_object(props, '$.k') AS BIGINT) AS _k",
        ],
        [
            "event_time", "user_id", "event_type", *_MILES_COLUMNS,
            f"{_case_index('_k % 3', PLATFORMS)} AS platform",
            f"{_case_index('_k % 4', UTM_SOURCES)} AS utm_source",
            f"{_case_index('_k % 5', COUNTRIES)} AS country",
        ],
    ),
    "orders": (
        [
            "CAST(o_orderdate AS TIMESTAMP_NTZ) AS event_time",
            "CAST(o_custkey AS BIGINT) AS user_id",
            f"{_case_map('o_orderstatus', ORDERS_TYPE_MAP, keep_other=False)} AS event_type",
            "o_totalprice AS _amount",
            "o_orderpriority AS platform",
            "concat('orders-', o_orderstatus) AS utm_source",
            f"{_case_index('o_custkey % 5', COUNTRIES)} AS country",
        ],
        ["event_time", "user_id", "event_type", *_MILES_COLUMNS, "platform", "utm_source", "country"],
    ),
}


def from_events_table(events: DataFrame) -> DataFrame:
    """Map the driver's ``events`` table (dense, one month) onto the source."""
    staged, columns = ADAPTERS["events"]
    return events.selectExpr(*staged).selectExpr(*columns)


def from_orders_table(orders: DataFrame) -> DataFrame:
    """Map the driver's ``orders`` table (sparse, 6.6 years) onto the source."""
    staged, columns = ADAPTERS["orders"]
    return orders.selectExpr(*staged).selectExpr(*columns)


def adapter_sql(source: str, table: str) -> str:
    """The same mapping as SQL text over a catalog table."""
    staged, columns = ADAPTERS[source]
    return f"SELECT {', '.join(columns)} FROM (SELECT {', '.join(staged)} FROM {table})"


SOURCES = {"events": from_events_table, "orders": from_orders_table}

# Declared schemas of the driver tables: reading with them skips the footer
# inference job, and column pruning still narrows the scan.
RAW_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
}


def catalog_source(spark: SparkSession, sf_dir: str, source: str = "events") -> str:
    """Enter a test table's files in the session catalog, and the event stream
    over them as a view; returns the view's name.  No file is read or copied."""
    path = f"{sf_dir.rstrip('/')}/{source}.parquet"
    place = f"{source}_{zlib.crc32(path.encode()):08x}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS lifetide_raw_{place} ({RAW_SCHEMAS[source]}) USING parquet LOCATION '{path}'")
    # Files may have been replaced since another call listed them.
    spark.catalog.refreshTable(f"lifetide_raw_{place}")
    spark.sql(f"CREATE OR REPLACE VIEW lifetide_stream_{place} AS {adapter_sql(source, f'lifetide_raw_{place}')}")
    return f"lifetide_stream_{place}"


def load_source(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    """Read ``{sf_dir}/{source}.parquet`` and adapt it to the source schema."""
    raw = spark.read.schema(RAW_SCHEMAS[source]).parquet(f"{sf_dir.rstrip('/')}/{source}.parquet")
    return SOURCES[source](raw)
