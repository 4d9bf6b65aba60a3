from __future__ import annotations

import math
import random

import numpy as np
import pytest

from lifetide.llm import hard_negatives
from lifetide.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, row string, side int, score string"


def brute(rows, is_anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    """Every anchor against every row, sorted whole."""
    part = []
    for i, e, label in rows:
        if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            part.append((i, [math.floor(scale * float(np.float32(x))) for x in e], label))
    place = lambda i: (i is None, i or 0)
    out = []
    for a, (anchor, x, label) in enumerate(part):
        if anchor is None or not is_anchor(anchor):
            continue
        scored = [(sum(p * q for p, q in zip(x, y)), i, other) for b, (i, y, other) in enumerate(part) if b != a]
        scored.sort(key=lambda s: (-s[0], place(s[1])))
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and low * p <= 100 * s[0] <= high * p][:negatives]
            out += [(anchor, positive, r, i, p, s) for r, (s, i, _) in enumerate(fit, 1)]
    return sorted(out, key=str)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(i, e, x, "x", 1, "y") for i, e, x in rows], SCHEMA)
    return sorted((tuple(r) for r in hard_negatives.mine(df, "vec_id % 50 = 0", **more).collect()), key=str)


def random_rows(n, dimension, labels, seed, hot=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = 0 if hot and i % 3 == 0 else rng.randrange(labels)
        rows.append((i, [rng.gauss(0.1 * (label == 1), 0.2) for _ in range(dimension)], label))
    return rows


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True)])
def test_as_by_brute_force(spark, seed, hot):
    rows = random_rows(1500, 8, 4, seed, hot)
    assert mined(spark, rows) == brute(rows, lambda i: i % 50 == 0)


def test_groups_do_not_matter(spark, monkeypatch):
    """Many small groups and batches of scores give the same rows as one."""
    rows = random_rows(600, 4, 3, 3)
    want = brute(rows, lambda i: i % 50 == 0)
    monkeypatch.setattr(hard_negatives, "GROUP_CELLS", 128)
    monkeypatch.setattr(hard_negatives, "SCORE_CELLS", 64)
    assert mined(spark, rows) == want


def test_ties_repeated_rows_and_what_takes_no_part(spark):
    rows = [(i, [float(i % 3), 1.0], i % 2) for i in range(120)]
    rows += [(50, [1.0, 1.0], 0), (50, [1.0, 1.0], 0), (100, [0.0, 1.0], 1)]
    rows += [(None, [2.0, 1.0], 0), (None, [2.0, 1.0], 1), (150, None, 0), (200, [1.0, None], 0), (250, [float("nan"), 1.0], 0)]
    rows += [(300, [float("inf"), 1.0], 1), (350, [1.0, 1.0], None), (400, [-1.0, -1.0], 0), (450, [0.0, 0.0], 1), (500, [], 0), (550, [1.0], 1)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 50 == 0)
    assert mined(spark, rows, positives=2, negatives=7, low=10, high=100) == brute(rows, lambda i: i % 50 == 0, 2, 7, 10, 100)


def test_scores_beyond_exact_doubles(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(0, 1e6) for _ in range(5)], i % 2) for i in range(200)]
    assert mined(spark, rows, scale=1024) == brute(rows, lambda i: i % 50 == 0, scale=1024)


def test_no_rows_and_no_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []
    assert mined(spark, [(50, [1.0], 0)]) == []


def test_query(spark, tmp_path):
    rows = random_rows(700, 6, 10, 9)
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, e, (x + 1) % 10 if i % 7 == 0 else x) for i, e, x in rows]
    got = QUERIES["op11_secondary_sort_negatives"](spark, str(tmp_path))
    assert got.dtypes[2] == ("rank", "int")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(moved, lambda i: i % 50 == 0)
