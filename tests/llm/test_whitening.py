from __future__ import annotations

import math

import numpy as np
import pytest

from lifetide.llm import whitening
from lifetide.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, n string, block int, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, "x", 1, "y") for i, e in rows], SCHEMA)


def plain(rows, components=8, scale=1024, shift=100_000):
    """Covariance formed whole, numpy's eigenvectors."""
    kept = [(i, e) for i, e in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    wide = max(1, *(len(e) for _, e in kept))
    x = [[math.floor(scale * float(np.float32(v))) + shift for v in e] + [shift] * (wide - len(e)) for _, e in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x]
    y = np.array([[(n * v - s) / n for v, s in zip(row, sums)] for row in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    return [i for i, _ in kept], deviation, y, e[::-1][:components], u[:, ::-1][:, :components], np.trace(y.T @ y / n)


def vectors(n, dimension, seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((n, dimension)) * np.linspace(0.1, 0.3, dimension) + rng.uniform(-3, 3, dimension)
    return [(i, [float(v) for v in row]) for i, row in enumerate(a)]


@pytest.mark.parametrize("n,dimension", [(900, 12), (400, 64), (300, 5)])
def test_as_by_whole_covariance(spark, n, dimension):
    rows = vectors(n, dimension, dimension)
    ids, deviation, y, e, u, trace = plain(rows)
    got = whitening.whiten(frame(spark, rows).repartition(5)).toPandas()
    wanted = min(8, dimension)
    assert len(got) == n * wanted and set(got["n"]) == {n}
    assert dict(zip(got["vec_id"], got["deviation"])) == dict(zip(ids, deviation))
    z = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    want = y @ u / np.sqrt(e)
    want *= np.sign((want * z).sum(0))
    assert np.abs(z - want).max() < 1e-8
    share = got.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(share, e / trace, rtol=1e-10)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-10
    centred = z - z.mean(0)
    assert np.abs(centred.T @ centred / n - np.eye(wanted)).max() < 1e-10


def test_residuals_are_at_double_precision():
    rng = np.random.default_rng(1)
    for spread in (np.ones(50), np.linspace(1, 1.01, 50), 10.0 ** -np.arange(50), np.repeat([3.0, 2.0], 25)):
        q, _ = np.linalg.qr(rng.standard_normal((50, 50)))
        v = (q * spread) @ q.T
        e, u = whitening.jacobi_davidson(lambda w, v=v: v @ w, 50, 8)
        assert np.linalg.norm(v @ u - u * e, axis=0).max() < 1e-13 * spread.max()
        assert np.abs(u.T @ u - np.eye(8)).max() < 1e-13
        assert np.allclose(e, np.sort(spread)[::-1][:8], rtol=0, atol=1e-13 * spread.max())


def test_minres_solves_symmetric_systems():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((20, 20))
    a, b = a + a.T, rng.standard_normal((20, 3))
    b[:, 2] = 0
    x = whitening.minres(lambda v: a @ v, b, 60, 1e-14)
    assert np.abs(a @ x - b).max() < 1e-10 and not x[:, 2].any()


def test_what_is_dropped_repeated_or_short(spark):
    rows = vectors(40, 3, 7) + [(1, [0.5, 0.25, 2.0]), (1, [0.5, 0.25, 2.0]), (None, [0.1, 0.2, 0.3]), (60, []), (61, [1.0])]
    rows += [(70, None), (71, [1.0, None, 2.0]), (72, [float("nan"), 0.0, 0.0]), (73, [0.0, float("-inf"), 0.0])]
    ids, deviation, *_ = plain(rows)
    got = whitening.whiten(frame(spark, rows)).where("component = 1").collect()
    assert sorted((str(r["vec_id"]), r["deviation"]) for r in got) == sorted((str(i), d) for i, d in zip(ids, deviation))


def test_degenerate_tables(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    one = whitening.whiten(frame(spark, [(5, [1.0, 2.0])])).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [
        (1, 1, 0, None, None, None), (2, 1, 0, None, None, None)
    ]
    line = whitening.whiten(frame(spark, [(i, [i / 64, 2 * i / 64, 1.0]) for i in range(20)])).toPandas()
    assert line[line["component"] == 1]["whitened"].notna().all() and line[line["component"] > 1]["whitened"].isna().all()
    assert line["identity_error"].iloc[0] < 1e-10


def test_deviation_beyond_a_long_is_null(spark):
    got = whitening.whiten(frame(spark, [(0, [1e15, 0.0]), (1, [0.0, 0.0]), (2, [0.0, 0.0])])).where("component = 1").collect()
    assert {r["vec_id"]: r["deviation"] is None for r in got} == {0: True, 1: True, 2: True}


def test_query(spark, tmp_path):
    rows = [(i, e, 0) for i, e in vectors(200, 10, 4)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op12_jacobi_davidson_whitening"](spark, str(tmp_path))
    assert [c for c, _ in got.dtypes] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 1600
