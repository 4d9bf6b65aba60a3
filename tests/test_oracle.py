"""Every registered query against its DuckDB SQL (a brute-force specification).

Runs on the driver's sf0.001 tables and on seeded random ``events`` tables
and ``orders`` tables that add what the driver data lacks: NULL users, times,
types and amounts, tied timestamps, multi-week gaps and month boundaries.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

import numpy as np
import pandas as pd
import pytest

from lifetide.plans.queries import EARLIER_NAMES, REGISTRY
from tests.compare import compare, duck

SF0001 = "/root/testdata/sf0.001"
NAMES = sorted(set(REGISTRY) - set(EARLIER_NAMES))


@pytest.mark.parametrize("name", NAMES)
def test_registry_matches_oracle_sf0001(spark, name):
    if not os.path.exists(f"{SF0001}/events.parquet"):
        pytest.skip("driver test data not present")
    con = duck(SF0001)
    ok, msg = compare(REGISTRY[name].run(spark, SF0001), con, REGISTRY[name].sql)
    assert ok, msg


def random_events(seed: int, n: int = 600, hot_share: float = 0.0) -> pd.DataFrame:
    """Random driver-shaped ``events`` rows; ``hot_share`` of them go to user 1."""
    rng = np.random.default_rng(seed)
    start = dt.datetime(2024, 1, 20)
    users = rng.integers(1, 12, n).astype("float")
    users[rng.random(n) < hot_share] = 1
    users[rng.random(n) < 0.03] = np.nan
    # Users are active in bursts separated by gaps of days to weeks.
    day = rng.choice(np.r_[0:6, 14:17, 30:33, 45, 60:70], n)
    secs = rng.integers(0, 4, n) * 3600  # few distinct instants: many ties
    ts = [start + dt.timedelta(days=int(d), seconds=int(s)) for d, s in zip(day, secs)]
    ts = pd.Series(ts, dtype="datetime64[us]")
    ts[rng.random(n) < 0.03] = pd.NaT
    types = np.array(["purchase", "signup", "view", "click", "error", None], dtype=object)
    etype = types[rng.integers(0, len(types), n)]
    value = rng.random(n) * 50
    value[rng.random(n) < 0.05] = np.nan
    ks = rng.integers(0, 100, n)
    props = [json.dumps({"k": int(k)}) if r > 0.05 else None for k, r in zip(ks, rng.random(n))]
    return pd.DataFrame({
        "event_id": np.arange(n, dtype="int64"),
        "ts": ts,
        "user_id": pd.array(users, dtype="Int64"),
        "event_type": etype,
        "value": value,
        "props": props,
    })


@pytest.fixture(scope="module", params=[(7, 0.0), (13, 0.34)], ids=["r7", "hot13"])
def random_dir(request):
    seed, hot = request.param
    d = tempfile.mkdtemp(prefix=f"lifetide-rand-{seed}-")
    random_events(seed, hot_share=hot).to_parquet(f"{d}/events.parquet", index=False)
    random_orders(seed, hot).to_parquet(f"{d}/orders.parquet", index=False)
    return d


def random_orders(seed: int, hot_share: float, n: int = 400) -> pd.DataFrame:
    """Random ``orders`` rows over two years: sparse, with ties and long gaps."""
    rng = np.random.default_rng(seed + 100)
    users = rng.integers(1, 15, n).astype("float")
    users[rng.random(n) < hot_share] = 1
    users[rng.random(n) < 0.03] = np.nan
    day = rng.choice(np.r_[0:3, 40:44, 75, 160:163, 400, 640:660], n)
    times = pd.Series([dt.datetime(2022, 12, 20) + dt.timedelta(days=int(d)) for d in day], dtype="datetime64[us]")
    times[rng.random(n) < 0.03] = pd.NaT
    price = rng.random(n) * 900
    price[rng.random(n) < 0.05] = np.nan
    pick = lambda values: np.array(values, dtype=object)[rng.integers(0, len(values), n)]
    return pd.DataFrame({
        "o_orderkey": np.arange(n, dtype="int64"),
        "o_custkey": pd.array(users, dtype="Int64"),
        "o_orderstatus": pick(["F", "P", "O", None]),
        "o_totalprice": price,
        "o_orderdate": times,
        "o_orderpriority": pick(["1-URGENT", "5-LOW", None]),
    })


@pytest.mark.parametrize("name", NAMES)
def test_registry_matches_oracle_random(spark, random_dir, name):
    con = duck(random_dir)
    ok, msg = compare(REGISTRY[name].run(spark, random_dir), con, REGISTRY[name].sql)
    assert ok, msg


@pytest.mark.parametrize("name", NAMES)
def test_oracle_statements_work_as_views(name):
    con = duck(SF0001)
    con.execute(f"CREATE VIEW checked AS {REGISTRY[name].sql}")
    assert con.execute("DESCRIBE checked").fetchall()


def test_earlier_names_are_the_same_queries():
    assert all(REGISTRY[old] is REGISTRY[new] for old, new in EARLIER_NAMES.items())
