from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lifetide.session import checkpoint_dir, local_session  # noqa: E402
from lifetide.sources.events import EVENT_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, app_name="lifetide-tests")
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="lifetide-ckpt-"))
    yield s
    s.stop()


def ts(day: str, hms: str = "12:00:00") -> dt.datetime:
    return dt.datetime.fromisoformat(f"{day}T{hms}")


def make_events(spark, rows):
    """rows: tuples (event_time, user_id, event_type[, miles_amount[, platform, utm, country]])."""
    full = []
    for r in rows:
        r = tuple(r)
        t, u, e = r[0], r[1], r[2]
        amount = r[3] if len(r) > 3 else None
        attrs = r[4:7] if len(r) > 4 else ("web", "organic", "US")
        cat = "miles" if e in ("miles_earned", "miles_redeemed") else "engagement"
        full.append((t, u, e, cat, amount, *attrs))
    return spark.createDataFrame(full, EVENT_SCHEMA)
