"""Whitening by Jacobi-Davidson, without forming the covariance.

The leading eigenvectors of the covariance V of fixed-point vectors
``x = floor(scale * c) + shift`` are found from products ``V w`` alone.  A
product is one Spark job over the stored vectors: every block centres its rows
first, multiplies them by the d x k matrix ``w`` (k is at most ``components``)
and by its own transpose, and the d x k sums are added up in a tree.  Nothing
of the size of the data or of d x d reaches the driver.

Each outer step is a Rayleigh-Ritz step in a small subspace.  Leading Ritz
pairs whose residual is at double precision are locked.  For the others the
correction equations ``(I - UU')(V - theta I)(I - UU') t = -r`` (U: the locked
vectors and the pair's own) are solved by a few steps of MINRES, all in step,
so one job serves them all; the corrections widen the subspace, which restarts
from its best Ritz vectors when it is full.

Centring is exact up to one rounding: ``x`` minus the nearest integer to its
mean is an integer, and the rest of the mean is a fraction of magnitude 1/2.

Input columns ``vec_id, embedding``; others are ignored whatever their names.
Rows whose vector is null or holds null or non-finite entries are dropped;
repeated rows count as often as they come; a null ``vec_id`` is kept; entries
that a shorter vector lacks are 0.  With fewer dimensions than components
there is one component a dimension.  Where a component's eigenvalue is 0 (a
constant or a dependent dimension, or a single row) ``whitened`` is null; where
the trace is 0 ``explained`` is null.  A ``deviation`` beyond a long is null.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifetide.llm.common import discard, stored
from lifetide.llm.vectors import complete, fixed, matrix

#: Numbers of a block of vectors (2 MB as doubles).
BLOCK_CELLS = 1 << 18
#: Numbers that one task multiplies at least: less is not worth a task of its own.
TASK_CELLS = 1 << 20
#: MINRES steps for a correction, and outer steps before giving up.
INNER_STEPS, OUTER_STEPS = 4, 300
EPS = float(np.finfo(float).eps)
WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)

Product = Callable[[np.ndarray], np.ndarray]


def unit_columns(a: np.ndarray) -> np.ndarray:
    return a / np.linalg.norm(a, axis=0)


def widened(basis: np.ndarray, more: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Orthonormal columns that ``more`` adds to ``basis`` and ``off``."""
    kept: list[np.ndarray] = []
    for t in more.T:
        size = np.linalg.norm(t)
        for _ in range(3):
            for q in (off, basis, np.array(kept).T if kept else None):
                if q is not None and q.size:
                    t = t - q @ (q.T @ t)
        left = np.linalg.norm(t)
        if size > 0 and left > 1e-10 * size:
            kept.append(t / left)
    return np.array(kept).T if kept else np.zeros((len(more), 0))


def minres(times: Product, b: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Columns x with ``A x`` near ``b``, for symmetric operators side by side."""
    x, w_old, w = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    before, now = np.zeros_like(b), b.copy()
    start = beta = np.linalg.norm(b, axis=0)
    beta_old = np.ones_like(beta)
    phi_bar, cs, sn = beta.copy(), -np.ones_like(beta), np.zeros_like(beta)
    d_bar, eps_next = np.zeros_like(beta), np.zeros_like(beta)
    for step in range(steps):
        live = beta > EPS * start
        if not live.any() or (phi_bar <= tolerance * start).all():
            break
        v = np.where(live, now / np.where(live, beta, 1), 0)
        y = times(v)
        if step:
            y = y - before * (beta / beta_old)
        alpha = (v * y).sum(0)
        y = y - now * np.where(live, alpha / np.where(live, beta, 1), 0)
        before, now, beta_old = now, y, np.where(live, beta, 1)
        beta = np.where(live, np.linalg.norm(y, axis=0), 0)
        eps_old, delta = eps_next, cs * d_bar + sn * alpha
        g_bar = sn * d_bar - cs * alpha
        eps_next, d_bar = sn * beta, -cs * beta
        gamma = np.maximum(np.hypot(g_bar, beta), EPS * EPS)
        cs, sn = np.where(live, g_bar / gamma, cs), np.where(live, beta / gamma, sn)
        phi, phi_bar = cs * phi_bar * live, np.where(live, sn * phi_bar, phi_bar)
        w_old, w = w, (v - eps_old * w_old - delta * w) / gamma
        x = x + phi * w * live
    return x


def jacobi_davidson(times: Product, dimension: int, wanted: int, inner: int = INNER_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors
    (columns) of the symmetric operator ``times``, to double precision."""
    rng = np.random.default_rng(20)
    room = min(dimension, 5 * wanted)
    none = np.zeros((dimension, 0))
    locked, values, images = none, [], none
    basis = widened(none, rng.standard_normal((dimension, wanted)), none)
    image = times(basis)
    largest = 0.0
    for outer in range(OUTER_STEPS):
        h = basis.T @ image
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        ritz, ritz_image = basis @ s, image @ s
        largest = max([largest, *np.abs(theta), *values])
        residual = ritz_image - ritz * theta
        size = np.linalg.norm(residual, axis=0)
        tolerance = 8 * np.sqrt(dimension) * EPS * largest
        # Leading pairs only, so that no larger one is passed over.
        done = 0
        while done < min(wanted - len(values), len(size)) and size[done] <= tolerance:
            done += 1
        locked, images = np.hstack([locked, ritz[:, :done]]), np.hstack([images, ritz_image[:, :done]])
        values += theta[:done].tolist()
        left = wanted - len(values)
        if not left:
            break
        ritz, ritz_image, residual, theta = (a[..., done:] for a in (ritz, ritz_image, residual, theta))
        basis, image = (ritz, ritz_image) if ritz.shape[1] + left <= room else (ritz[:, : 2 * wanted], ritz_image[:, : 2 * wanted])
        u, at = ritz[:, :left], theta[:left]

        def projected(t: np.ndarray, u: np.ndarray = u, off: np.ndarray = locked) -> np.ndarray:
            t = t - off @ (off.T @ t)
            return t - u * (u * t).sum(0)

        def corrected(t: np.ndarray, at: np.ndarray = at) -> np.ndarray:
            t = projected(t)
            return projected(times(t) - t * at)

        more = widened(basis, minres(corrected, -projected(residual[:, : u.shape[1]]), inner, 0.5 ** (outer + 2)), locked)
        if more.shape[1] == 0:
            more = widened(basis, rng.standard_normal((dimension, left)), locked)
        if more.shape[1] == 0:
            # The basis is the whole space: its Ritz pairs are as exact as products are.
            locked, values = np.hstack([locked, u]), values + at.tolist()
            break
        basis, image = np.hstack([basis, more]), np.hstack([image, times(more)])
    else:
        raise RuntimeError(f"{len(values)} of {wanted} eigenpairs after {OUTER_STEPS} steps")
    order = np.argsort(values)[::-1]
    return np.array(values)[order], unit_columns(locked[:, order])


@dataclass(frozen=True)
class Whitener:
    """What a fit found: exact sums a dimension, unit eigenvectors as columns,
    eigenvalues, and the largest entry of the whitened covariance minus I."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float | None
    scale: int
    shift: int

    @property
    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        return split_mean(self.sums, self.n)


def split_mean(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean as the nearest integer and the fraction that is left."""
    whole = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(whole, np.int64), np.array([(s - n * w) / n for s, w in zip(sums, whole)])


def _integers(column: pa.Array, dimension: int, scale: int, shift: int) -> np.ndarray:
    return fixed(matrix(column, dimension), scale).astype(np.int64) + shift


def _exact_sums(block: np.ndarray) -> list[int]:
    high, low = block >> 31, block & 0x7FFFFFFF
    return [(h << 31) + x for h, x in zip(high.sum(0).tolist(), low.sum(0).tolist())]


class Blocks:
    """The stored vectors, a block of integers a row, and sums over them."""

    def __init__(self, vectors: DataFrame, n: int, dimension: int, scale: int, shift: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, BLOCK_CELLS // dimension)
            for batch in batches:
                for at in range(0, batch.num_rows, step):
                    x = _integers(batch.column(0).slice(at, step), dimension, scale, shift)
                    narrow = len(x) == 0 or max(abs(int(x.min())), abs(int(x.max()))) < 1 << 31
                    width = 4 if narrow else 8
                    raw = x.astype(f"<i{width}").tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([raw], pa.binary())], ["width", "block"])

        self.dimension = dimension
        self.table = stored(vectors.select("embedding").mapInArrow(run, "width int, block binary"), "blocks")
        self.rdd = self.table.rdd.coalesce(max(1, -(-n * dimension // TASK_CELLS)))

    def total(self, of: Callable[[np.ndarray], object], plus: Callable) -> object:
        """``of`` a block, added up over all blocks (there must be one)."""
        dimension = self.dimension

        def part(rows: Iterator) -> Iterator[list]:
            out = None
            for r in rows:
                got = of(np.frombuffer(r.block, f"<i{r.width}").reshape(-1, dimension).astype(np.int64))
                out = got if out is None else plus(out, got)
            if out is not None:
                yield out

        return self.rdd.mapPartitions(part).treeReduce(plus)


def fit(vectors: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000) -> Whitener | None:
    """The whitener of all complete vectors; None if there are none."""
    usable = vectors.where(complete("embedding")).select("embedding")
    size = usable.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("d")).first()
    if not size["n"]:
        return None
    dimension = max(1, size["d"])
    blocks = Blocks(usable, size["n"], dimension, scale, shift)
    try:
        n, sums = blocks.total(lambda x: (len(x), _exact_sums(x)), lambda a, b: (a[0] + b[0], list(map(add, a[1], b[1]))))
        whole, rest = split_mean(sums, n)

        def centred(x: np.ndarray) -> np.ndarray:
            return (x - whole).astype(np.float64) - rest

        def times(w: np.ndarray) -> np.ndarray:
            def product(x: np.ndarray) -> np.ndarray:
                y = centred(x)
                return y.T @ (y @ w)

            return blocks.total(product, add) / n

        trace = blocks.total(lambda x: float((centred(x) ** 2).sum()), add) / n
        wanted = min(components, dimension)
        values, basis = jacobi_davidson(times, dimension, wanted)
        positive = values > max(16 * dimension * EPS * values[0], 0)
        scaled = np.where(positive, basis / np.sqrt(np.where(positive, values, 1)), 0)
        error = None
        if positive.any():
            middle = blocks.total(lambda x: (centred(x) @ scaled).sum(0), add) / n

            def spread(x: np.ndarray) -> np.ndarray:
                z = centred(x) @ scaled - middle
                return z.T @ z

            found = blocks.total(spread, add) / n - np.diag(positive.astype(float))
            error = float(np.abs(found).max())
        explained = values / trace if trace > 0 else np.full(wanted, np.nan)
        return Whitener(n, sums, basis, np.where(positive, values, 0), explained, error, scale, shift)
    finally:
        discard(blocks.table)


def transform(vectors: DataFrame, whitener: Whitener | None) -> DataFrame:
    """``WHITENED`` rows of every complete vector, one per component."""
    usable = vectors.where(complete("embedding")).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    if whitener is None:
        return usable.limit(0).selectExpr(*[f"cast(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in WHITENED.split(", ")])
    m = whitener
    dimension, wanted = m.vectors.shape
    whole, rest = m.mean
    known = m.values > 0
    scaled = np.where(known, m.vectors / np.sqrt(np.where(known, m.values, 1)), 0)
    # n * x - S of a row, from the distance to the whole mean.
    offset = [s - m.n * w for s, w in zip(m.sums, whole.tolist())]

    def deviations(near: np.ndarray) -> list[int | None]:
        reach = m.n * (int(np.abs(near).max(initial=0)) + 1)
        if dimension * reach * reach < 1 << 63:
            return ((m.n * near - np.array(offset, np.int64)) ** 2).sum(1).tolist()
        exact = [sum((m.n * x - o) ** 2 for x, o in zip(row, offset)) for row in near.tolist()]
        return [x if x < 1 << 63 else None for x in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, BLOCK_CELLS // dimension)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                near = _integers(part.column(1), dimension, m.scale, m.shift) - whole
                z = (near.astype(np.float64) - rest) @ scaled
                rows = part.num_rows
                every = np.repeat(np.arange(rows), wanted)
                number = np.tile(np.arange(1, wanted + 1, dtype=np.int32), rows)
                lacks = np.tile(~known, rows)
                explained = np.tile(m.explained, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(every)),
                        pa.array(number),
                        pa.array(np.full(len(every), m.n, np.int64)),
                        pa.array(deviations(near), pa.int64()).take(pa.array(every)),
                        pa.array(z.ravel(), mask=lacks),
                        pa.array(explained, mask=np.isnan(explained)),
                        pa.array([m.identity_error] * len(every), pa.float64()),
                    ],
                    [c.split()[0] for c in WHITENED.split(", ")],
                )

    return usable.mapInArrow(run, WHITENED)


def whiten(vectors: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """``WHITENED`` rows of every complete vector under a fit to all of them."""
    return transform(vectors, fit(vectors, components, scale, shift))
