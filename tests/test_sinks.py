"""Publishing as a whole, sorted and sized files, stored views, runs of days."""

from __future__ import annotations

import glob
import os
import signal
import subprocess
import sys
import tempfile
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lifetide.operators import (
    expand_run_status,
    expand_runs,
    growth,
    run_status,
    user_day_activity,
    user_day_runs,
    user_day_spine,
    user_day_status,
)
from lifetide.plans.pipeline import SORT_KEYS, build_all, published_models
from lifetide.plans.queries import REGISTRY
from lifetide.sinks import create_views, drop_unpublished, publish, published_folder, read_published, write_table
from lifetide.sinks.tables import MARKERS, VERSION_PREFIX
from lifetide.sources.events import catalog_source, load_source
from tests.compare import spark_rows
from tests.conftest import ROOT, make_events, ts

SF = "/root/testdata/sf0.001"


def same(got, want) -> bool:
    return sorted(map(repr, spark_rows(got)[1])) == sorted(map(repr, spark_rows(want)[1]))


def files(path: str) -> list[str]:
    return sorted(glob.glob(f"{path}/**/part-*", recursive=True))


def test_a_new_version_replaces_the_old_one_at_once(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    first = publish(spark.range(5), path)
    old = read_published(spark, path)
    publish(spark.range(100, 103), path)
    assert [r[0] for r in read_published(spark, path).orderBy("id").collect()] == [100, 101, 102]
    # A reader of the version before is not cut off; the one before that goes.
    assert old.count() == 5 and os.path.exists(first)
    publish(spark.range(1), path)
    assert not os.path.exists(first) and len(os.listdir(f"{path}/{MARKERS}")) >= 2
    assert read_published(spark, path).count() == 1


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(10), path)
    # The first partitions are written before the last one fails.
    bad = spark.range(0, 1000, 1, 8).selectExpr("CASE WHEN id < 990 THEN id ELSE raise_error('stop') END AS id")
    with pytest.raises(Exception):
        publish(bad, path)
    assert read_published(spark, path).count() == 10
    assert len([d for d in os.listdir(path) if d.startswith(VERSION_PREFIX)]) == 1


KILLED = """
import sys
sys.path.insert(0, {root!r})
from lifetide.session import local_session
from lifetide.sinks import publish
spark = local_session(2)
slow = "CASE WHEN id % 50 = 49 THEN reflect('java.lang.Thread', 'sleep', 600000L) ELSE 'x' END"
publish(spark.range(0, 200, 1, 4).selectExpr("id + 1000 AS id", slow + " AS s").select("id", "s"), {path!r})
"""


def test_a_killed_build_leaves_the_old_rows(spark, tmp_path):
    """Another process is killed while it writes a new version."""
    path = str(tmp_path / "t")
    publish(spark.range(10).selectExpr("id", "'x' AS s"), path)
    before = published_folder(spark, path)
    run = subprocess.Popen(
        [sys.executable, "-c", KILLED.format(root=ROOT, path=path)], start_new_session=True, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL
    )
    try:
        until = time.time() + 120
        while len([d for d in os.listdir(path) if d.startswith(VERSION_PREFIX)]) < 2 and time.time() < until and run.poll() is None:
            time.sleep(0.2)
        time.sleep(1)
        assert run.poll() is None
    finally:
        os.killpg(run.pid, signal.SIGKILL)
        run.wait()
    half = [d for d in os.listdir(path) if d.startswith(VERSION_PREFIX) and not before.endswith(d)]
    assert len(half) == 1
    assert published_folder(spark, path) == before and read_published(spark, path).count() == 10
    # What it left is deleted once it is old; a younger folder may be a running build.
    assert drop_unpublished(spark, path) == [] and drop_unpublished(spark, path, hours=0) == half
    assert read_published(spark, path).count() == 10


def test_a_failed_build_leaves_the_models_of_the_build_before(spark, tmp_path):
    out, events = str(tmp_path / "out"), load_source(spark, SF, "events")
    build_all(spark, events.limit(300), out, include_spine=False)
    before = published_models(spark, out)
    rows = spark.read.parquet(f"{before}/growth_accounting_daily").count()
    with pytest.raises(Exception):
        build_all(spark, events, out, partition_by={"growth_accounting_monthly": ["no_such_column"]})
    assert published_models(spark, out) == before
    assert spark.read.parquet(f"{before}/growth_accounting_daily").count() == rows
    assert [d for d in os.listdir(out) if d.startswith(VERSION_PREFIX)] == [os.path.basename(before)]


def test_sorted_files_are_in_order_end_to_end(spark, tmp_path):
    """A user with a third of all rows, ties, null keys: every file begins
    where the one before ended, and no file holds the hot user whole."""
    n = 60_000
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7L WHEN id % 50 = 1 THEN NULL ELSE id % 997 END AS user_id",
        "date_add(DATE '2024-01-01', CAST(id % 400 AS INT)) AS cal_day",
        "CAST(id DIV 2 AS STRING) AS payload",
    ).repartition(5)
    path = str(tmp_path / "t")
    saved = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        write_table(df, path, sort_by=["user_id", "cal_day"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", saved)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    parts = files(path)
    held = [pq.read_table(f).to_pandas() for f in parts]
    keys = [[(u == u, u if u == u else 0, d) for u, d in zip(t["user_id"], t["cal_day"])] for t in held]
    flat = [k for part in keys for k in part]
    assert flat == sorted(flat) and len(flat) == n
    hot = [sum(k[1] == 7 and k[0] for k in part) for part in keys]
    assert len(parts) >= 12 and sum(h > 0 for h in hot) >= 4 and max(map(len, keys)) < 2.5 * n / len(parts)
    # Statistics let a reader of one user skip the other files' row groups.
    spans = []
    for f in parts:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(0).statistics
            spans.append((s.min, s.max) if s.has_min_max else (None, None))
    assert sum(lo is not None and lo <= 900 <= hi for lo, hi in spans) <= 2
    assert spark.read.parquet(path).where("user_id = 900").count() == df.where("user_id = 900").count()


def test_sorted_runs_are_sorted_days(spark, tmp_path):
    """Runs are ranged and sorted; the days written are in order and the spine."""
    act, path = user_day_activity(load_source(spark, SF, "orders")), str(tmp_path / "t")
    write_table(user_day_runs(act), path, sort_by=["user_id", "from_day"], then=expand_runs)
    rows = [tuple(r.values()) for f in files(path) for r in pq.ParquetFile(f).read(columns=["user_id", "cal_day"]).to_pylist()]
    assert len(rows) > 200_000 and rows == sorted(rows)
    assert same(spark.read.parquet(path), user_day_spine(act))


def test_ties_in_all_sort_columns_are_split(spark, tmp_path):
    df = spark.range(40_000).selectExpr("1L AS user_id", "DATE '2024-01-01' AS cal_day", "id AS payload")
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table(df, path, sort_by=["user_id", "cal_day"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(files(path)) >= 3 and spark.read.parquet(path).distinct().count() == 40_000


@pytest.mark.parametrize("sort_by", [None, ["id"]])
def test_sorted_and_partitioned_tables_hold_all_rows(spark, tmp_path, sort_by):
    df = spark.range(5000).selectExpr("id", "id % 7 AS p", "cast(id % 3 AS string) AS s")
    path = str(tmp_path / "t")
    write_table(df, path, partition_by=["p"], sort_by=sort_by)
    back = spark.read.parquet(path).selectExpr("id", "CAST(p AS BIGINT) AS p", "s")
    assert same(back, df) and len(glob.glob(f"{path}/p=*")) == 7
    for folder in glob.glob(f"{path}/p=*") if sort_by else []:
        ids = [x for f in files(folder) for x in pq.ParquetFile(f).read(columns=["id"])["id"].to_pylist()]
        assert ids == sorted(ids)
    empty = str(tmp_path / "e")
    write_table(df.limit(0), empty, sort_by=["id"])
    assert spark.read.parquet(empty).count() == 0


def test_files_of_a_partitioned_table_follow_its_size(spark, tmp_path):
    """Small directories have one file each; a large one is split."""
    df = spark.range(400_000).selectExpr("CASE WHEN id % 2 = 0 THEN 0 ELSE id % 40 END AS p", "id", "xxhash64(id) AS a", "xxhash64(id, 1) AS b")
    path = str(tmp_path / "t")
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1m", "spark.sql.shuffle.partitions": "500"}
    saved = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        write_table(df, path, partition_by=["p"])
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    counts = {os.path.basename(d): len(files(d)) for d in glob.glob(f"{path}/p=*")}
    assert counts.pop("p=0") > 2 and len(counts) == 20 and max(counts.values()) <= 2
    small = str(tmp_path / "s")
    write_table(growth(user_day_activity(load_source(spark, SF, "orders")), "day"), small, partition_by=["cal_month"])
    assert len(files(small)) == len(glob.glob(f"{small}/cal_month=*"))


@pytest.mark.parametrize("source", ["events", "orders"])
def test_stored_views_in_another_session(spark, source):
    """Each view is read by its name in a session that only has the catalog."""
    keys = {
        "calendar": "events_calendar", "dim_users": "dim_users", "fct_events": "fct_events", "event_ordinal": "event_ordinal",
        **{f"triangle_retention_{g}": f"triangle_{g}" for g in ("daily", "weekly", "monthly")},
    }
    names = create_views(spark, catalog_source(spark, SF, source), prefix=f"stored_{source}_")
    assert set(names) == set(keys)
    other = spark.newSession()
    sfx = "" if source == "events" else "_orders"
    for model, name in names.items():
        assert spark.catalog.getTable(name).tableType == "VIEW"
        assert same(other.sql(f"SELECT * FROM {name}"), REGISTRY[f"{keys[model]}{sfx}"].run(spark, SF)), model


def test_stored_views_of_a_build(spark, tmp_path):
    events = catalog_source(spark, SF, "events")
    out = str(tmp_path / "out")
    paths = build_all(
        spark, spark.table(events), out, spine="runs", sorted_tables=True, lazy_views=True, event_table=events, catalog_prefix="built_"
    )
    other = spark.newSession()
    for name, key in {
        "growth_transactions": "user_day_spine", "growth_accounting_frm_day": "user_day_status", "dim_users": "dim_users",
        "event_ordinal": "event_ordinal", "growth_accounting_weekly": "growth_weekly", "triangle_retention_daily": "triangle_daily",
    }.items():
        assert same(other.table(f"built_{name}"), REGISTRY[key].run(spark, SF)), name
    assert "growth_transactions" not in paths and "growth_transactions_runs" in paths and "dim_users" not in paths
    with pytest.raises(ValueError):
        build_all(spark, spark.table(events), out, lazy_views=True, catalog_prefix="built_")
    with pytest.raises(ValueError):
        build_all(spark, spark.table(events), out, spine="weeks")


def test_sorted_models_of_a_build(spark, tmp_path):
    paths = build_all(spark, load_source(spark, SF, "orders"), str(tmp_path / "out"), sorted_tables=True)
    for name in ("growth_transactions", "triangle_retention_daily"):
        rows = [tuple(r.values()) for f in files(paths[name]) for r in pq.ParquetFile(f).read(columns=SORT_KEYS[name]).to_pylist()]
        assert rows and rows == sorted(rows)


def test_runs_expand_to_the_spine_and_are_few(spark):
    for source in ("events", "orders"):
        act = user_day_activity(load_source(spark, SF, source))
        spine, runs = user_day_spine(act), user_day_runs(act)
        assert same(expand_runs(runs), spine)
        assert same(expand_run_status(run_status(runs)), user_day_status(spine))
        assert runs.count() <= 3 * act.count()


def test_runs_of_gaps_of_every_length(spark):
    """Days apart by 1 to 4, a single day, a user without days."""
    days = ["2024-01-01", "2024-01-02", "2024-01-04", "2024-01-07", "2024-01-11"]
    events = make_events(spark, [(ts(d), 1, "app_open") for d in days] + [(ts("2024-02-01"), 2, "miles_earned", 5), (None, 3, "app_open")])
    runs = user_day_runs(user_day_activity(events))
    got = [(r["user_id"], str(r["from_day"]), str(r["to_day"]), r["trns_day"] is not None, r["prev_day"] is not None) for r in runs.orderBy("user_id", "from_day").collect()]
    assert got == [
        (1, "2024-01-01", "2024-01-01", True, False),
        (1, "2024-01-02", "2024-01-02", True, True),
        (1, "2024-01-03", "2024-01-03", False, True),
        (1, "2024-01-04", "2024-01-04", True, False),
        (1, "2024-01-05", "2024-01-05", False, True),
        (1, "2024-01-06", "2024-01-06", False, False),
        (1, "2024-01-07", "2024-01-07", True, False),
        (1, "2024-01-08", "2024-01-08", False, True),
        (1, "2024-01-09", "2024-01-10", False, False),
        (1, "2024-01-11", "2024-01-11", True, False),
        (2, "2024-02-01", "2024-02-01", True, False),
    ]
    assert run_status(runs).where(F.col("churned") == 1).count() == 3
