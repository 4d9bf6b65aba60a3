"""Source readers: formats, names, types and time zones."""

from __future__ import annotations

import datetime as dt
import decimal
import tempfile

import pytest
from pyspark.sql import functions as F

from lifetide.operators import growth, transaction_breakdown, user_day_activity
from lifetide.sources.events import (
    EVENT_COLUMNS,
    EVENT_SCHEMA,
    check_event_schema,
    conform_events,
    read_event_stream,
    read_event_table,
)
from tests.conftest import make_events, ts


def _rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def _csv(text: str) -> str:
    path = tempfile.mkdtemp(prefix="lifetide-csv-") + "/events.csv"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_read_event_stream_formats(spark):
    ev = make_events(spark, [
        (ts("2024-01-01"), 1, "click", None, "ios", "ads", "US"),
        (ts("2024-01-02"), 2, "miles_earned", 7, "web", "email", "SG"),
        (None, None, None, None, None, None, None),
    ])
    for fmt, opts in (("parquet", {}), ("json", {}), ("csv", {"header": "true"}), ("orc", {})):
        d = tempfile.mkdtemp(prefix=f"lifetide-src-{fmt}-")
        ev.write.mode("overwrite").format(fmt).options(**opts).save(d)
        back = read_event_stream(spark, d, fmt)
        assert back.columns == EVENT_COLUMNS, fmt
        if fmt in ("parquet", "orc"):
            assert back.schema == EVENT_SCHEMA, fmt
        same = back.withColumn("miles_amount", F.col("miles_amount").cast("bigint"))
        assert _rows(same) == _rows(ev), fmt


def test_csv_columns_follow_the_header(spark):
    path = _csv("user_id,event_type,event_time,country\n5,click,2024-01-01 20:00:00,US\n6,view,2024-01-01T20:00:00+08:00,\n")
    got = {r["user_id"]: (r["event_time"], r["event_type"], r["country"]) for r in read_event_stream(spark, path, "csv").collect()}
    assert got == {5: (dt.datetime(2024, 1, 1, 20), "click", "US"), 6: (dt.datetime(2024, 1, 1, 12), "view", None)}


@pytest.mark.parametrize("row", ["x7,click,2024-01-01", "5,click,yesterday"])
def test_malformed_text_is_an_error(spark, row):
    path = _csv(f"user_id,event_type,event_time\n{row}\n")
    with pytest.raises(Exception, match="malformed"):
        read_event_stream(spark, path, "csv").collect()


def test_missing_required_column_is_an_error(spark):
    df = spark.createDataFrame([(1, "click", ts("2024-01-01"))], "user_id long, event_type string, event_ts timestamp_ntz")
    with pytest.raises(ValueError, match="event_time"):
        conform_events(df)


@pytest.mark.parametrize("zone", ["Asia/Manila", "America/New_York", "UTC"])
def test_instants_become_utc_days(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "SELECT timestamp_micros(t) AS event_time, 1L AS user_id, 'click' AS event_type FROM VALUES "
            "(1704139200123456L), (1730610000000000L), (1730613600000000L), (-1L) AS v(t)"
        )
        got = [r["event_time"] for r in conform_events(df).orderBy("event_time").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    base = dt.datetime(1970, 1, 1)
    want = [-1, 1704139200123456, 1730610000000000, 1730613600000000]
    assert got == [base + dt.timedelta(microseconds=t) for t in want]


def test_fractional_miles_stay_exact(spark):
    rows = [(ts("2024-01-01"), 1, "miles_earned", decimal.Decimal("1.90")), (ts("2024-01-01"), 1, "miles_earned", decimal.Decimal("0.15")),
            (ts("2024-01-09"), 1, "miles_redeemed", decimal.Decimal("0.50"))]
    ev = conform_events(spark.createDataFrame(rows, "event_time timestamp_ntz, user_id long, event_type string, miles_amount decimal(10,2)"))
    act = user_day_activity(ev)
    assert {r["day"].day: (r["miles_earned"], r["miles_redeemed"]) for r in act.collect()} == {
        1: (decimal.Decimal("2.05"), 0), 9: (0, decimal.Decimal("0.50"))
    }
    for grain in ("day", "week", "month"):
        long = growth(act, grain).where("user_type = 'miles_earned'").agg(F.sum("miles_pct")).first()[0]
        assert long == decimal.Decimal("2.05")
        assert transaction_breakdown(act, grain).agg(F.sum("miles_redeemed")).first()[0] == decimal.Decimal("0.50")
    double = conform_events(ev.withColumn("miles_amount", F.col("miles_amount").cast("double")))
    assert user_day_activity(double).agg(F.sum("miles_earned")).first()[0] == decimal.Decimal("2.05")


def test_read_event_table_checks_the_catalog_entry(spark):
    ev = make_events(spark, [(ts("2024-01-01"), 1, "click", None, "ios", "ads", "US"), (None, None, None)])
    path = tempfile.mkdtemp(prefix="lifetide-table-")
    ev.write.mode("overwrite").parquet(path)
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW odd AS SELECT CAST(1 AS DOUBLE) AS event_time, array(1L) AS user_id, 'x' AS platform")
    spark.sql(f"CREATE TABLE IF NOT EXISTS read_event_table_test USING parquet LOCATION '{path}'")
    try:
        back = read_event_table(spark, "read_event_table_test")
        assert back.schema == EVENT_SCHEMA and _rows(back) == _rows(ev)
        with pytest.raises(ValueError, match="event_type is missing.*event_time is double.*user_id is array"):
            read_event_table(spark, "odd")
        with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
            read_event_table(spark, "no_such_table")
    finally:
        spark.sql("DROP TABLE read_event_table_test")
    check_event_schema(EVENT_SCHEMA)


def test_catalog_source_follows_replaced_files(spark, tmp_path):
    from lifetide.sources import catalog_source

    def put(n):
        rows = spark.range(n).selectExpr("id AS event_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts", "id AS user_id", "'view' AS event_type", "1D AS value", "'{}' AS props")
        rows.write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")

    put(3)
    name = catalog_source(spark, str(tmp_path))
    assert read_event_table(spark, name).count() == 3
    put(5)
    assert read_event_table(spark, catalog_source(spark, str(tmp_path))).count() == 5
