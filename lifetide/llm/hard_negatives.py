"""Hard negatives by a secondary-sort shuffle.

The score of an anchor and a row is the inner product of their fixed-point
vectors.  An anchor's positives are its best rows of the same label; the hard
negatives of a positive are the best rows of another label whose score lies
between two percentages of the positive's.

Scores are packed into keys (anchor, descending score, positives first, id),
shuffled by anchor and sorted within partitions.  One pass over a partition
then reads each anchor's scores from the top: a positive opens its window, a
negative goes to every open window that its score lies in, until that has
enough.  An anchor is never held as a whole.

Only scores that can matter are shuffled.  Rows are dealt into groups of a
bounded size (``GROUP_CELLS`` numbers), each with all anchors streaming past it
in batches.  A first pass keeps the best rows of the same label of each group,
which hold the best of all; with those windows known, a second pass keeps each
group's best rows of every window.  So an anchor sends at most
``positives * (1 + negatives)`` scores a group, whatever its label's share is.

Input columns ``vec_id, embedding, label``; others are ignored whatever their
names.  Rows with a null label, a null vector, or a null or non-finite entry
take no part.  Ties go to the smaller ``vec_id`` (a null one comes last), then
to the earlier row.  Repeated rows are rows of their own: each is an anchor,
and the other ones are its positives.  Entries that a shorter vector lacks
count as 0.  Scores are exact; one beyond a long is held at the largest long.
An empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lifetide.llm.common import discard, stored
from lifetide.llm.vectors import complete, fixed, matrix

#: Numbers of a group of rows held by one task (32 MB), and scores made at a time (16 MB).
GROUP_CELLS, SCORE_CELLS = 4 << 20, 2 << 20
#: Rows under which a table is not dealt into more groups.
LEAST_ROWS = 1024
#: Integers up to here are exact as doubles.
EXACT = float(1 << 53)
LONGEST = (1 << 63) - 1

SCORED = "anchor long, score long, vec_id long, row long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
#: Anchor, reversed score, negative or positive, null id, id, row.
KEY = ">QQBBQQ"
POSITIVE, NEGATIVE = 0, 1


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integers held as doubles, as longs."""
    if not anchors.size or not rows.size:
        return np.zeros((len(anchors), len(rows)), np.int64)
    if np.abs(anchors).max() * np.abs(rows).max() * rows.shape[1] < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(anchors) @ whole(rows).T, -LONGEST, LONGEST).astype(np.int64)


def best(score: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the places ``at``, the ``k`` of the highest scores, ties by place."""
    if len(at) <= k:
        return at
    s = score[at]
    cut = np.partition(s, len(s) - k)[len(s) - k]
    over = at[s > cut]
    return np.concatenate([over, at[s == cut][: k - len(over)]])


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Scores from ``low`` to ``high`` percent of a positive's."""
    return -(-low * positive // 100), high * positive // 100


class Group:
    """The rows of one group, in the order of their ids."""

    def __init__(self, batches: list[pa.RecordBatch], dimension: int, scale: int):
        held = pa.Table.from_batches(batches)
        self.vectors = np.concatenate([fixed(matrix(c, dimension), scale) for c in held["embedding"].chunks])
        self.label = held["label"].to_numpy()
        self.row = held["row"].to_numpy()
        self.ids = held["vec_id"].combine_chunks()

    def found(self, batch: pa.RecordBatch, dimension: int, scale: int, pick) -> Iterator[pa.RecordBatch]:
        """``SCORED`` rows of a batch of anchors; ``pick`` chooses the places."""
        step = max(1, SCORE_CELLS // len(self.row))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            made = scores(fixed(matrix(part.column("embedding"), dimension), scale), self.vectors)
            anchor, picked, score = [], [], []
            opened = part.column("opened").to_pylist()
            for i, (row, label) in enumerate(zip(part.column("row").to_pylist(), part.column("label").to_pylist())):
                places = pick(self, made[i], row, label, opened[i])
                anchor.append(np.full(len(places), row, np.int64))
                picked.append(places)
                score.append(made[i][places])
            places = np.concatenate(picked)
            if len(places):
                columns = [np.concatenate(anchor), np.concatenate(score), self.ids.take(pa.array(places)), self.row[places]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "score", "vec_id", "row"])


def _against_groups(rows: DataFrame, anchors: DataFrame, groups: int, dimension: int, scale: int, pick) -> DataFrame:
    """Every group of rows with all anchors streaming past it."""
    group, none = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"), F.lit(None).cast("array<long>")
    sides = rows.select(group.alias("group"), F.lit(0).alias("side"), "row", "vec_id", "label", "embedding", none.alias("opened")).union(
        anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(1), "row", "vec_id", "label", "embedding", "opened")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held: Group | None = None
        for batch in batches:
            of_rows = int(batch.num_rows - batch.column("side").to_numpy().sum())
            if of_rows:
                waiting.append(batch.slice(0, of_rows))
            if of_rows < batch.num_rows and (waiting or held):
                if held is None:
                    held, waiting = Group(waiting, dimension, scale), []
                yield from held.found(batch.slice(of_rows), dimension, scale, pick)

    dealt = sides.repartitionById(groups, F.col("group")).sortWithinPartitions("side", F.col("vec_id").asc_nulls_last(), "row")
    return dealt.mapInArrow(run, SCORED)


def _packed(r) -> tuple[bytes, tuple[int, int | None]]:
    """Key and value of a score in the shuffle; the value is the ids."""
    low = 1 << 63
    return struct.pack(KEY, r.anchor, LONGEST - r.score, r.kind, r.vec_id is None, (r.vec_id or 0) + low, r.row), (r.anchor_id, r.vec_id)


def _by_anchor(key: bytes) -> int:
    """The anchor's number, mixed, so that evenly spaced ones spread."""
    return (int.from_bytes(key[:8], "big") * 0x9E3779B97F4A7C15 >> 29) & 0x7FFFFFFF


def mine(vectors: DataFrame, anchors: str, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """``MINED`` rows: for each row that the SQL condition ``anchors`` holds
    for and each of its ``positives`` best rows of the same label, the
    ``negatives`` best rows of other labels with a score from ``low`` to
    ``high`` percent of the positive's."""
    spark = vectors.sparkSession
    parts = vectors.where(F.col("label").isNotNull() & complete("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding"
    )
    rows = stored(parts.withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("d")).first()
    n, dimension = size["n"], max(1, size["d"])
    wide = -(-n * dimension // GROUP_CELLS)
    groups = max(1, wide, min(2 * spark.sparkContext.defaultParallelism, n // LEAST_ROWS))
    chosen = rows.where(anchors)

    def same(held: Group, score: np.ndarray, row: int, label: int, opened: None) -> np.ndarray:
        return best(score, np.flatnonzero((held.label == label) & (held.row != row)), positives)

    def other(held: Group, score: np.ndarray, row: int, label: int, opened: list[int]) -> np.ndarray:
        spans = [span for p in set(opened) if (span := window(p, low, high))[0] <= span[1]]
        if not spans:
            return np.zeros(0, np.int64)
        least, most = min(a for a, _ in spans), max(b for _, b in spans)
        at = np.flatnonzero((held.label != label) & (score >= least) & (score <= most))
        s = score[at]
        return np.unique(np.concatenate([best(score, at[(s >= a) & (s <= b)], negatives) for a, b in spans]))

    none = F.lit(None).cast("array<long>")
    line = Window.partitionBy("anchor").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    near = _against_groups(rows, chosen.withColumn("opened", none), groups, dimension, scale, same)
    near = stored(near.withColumn("place", F.row_number().over(line)).where(F.col("place") <= positives).drop("place"), "positives")

    opened = near.groupBy(F.col("anchor").alias("row")).agg(F.collect_list("score").alias("opened"))
    far = _against_groups(rows, chosen.join(opened, "row"), groups, dimension, scale, other)
    kept = near.withColumn("kind", F.lit(POSITIVE)).union(far.withColumn("kind", F.lit(NEGATIVE)))
    names = chosen.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sorted_scores = kept.join(names, "anchor").rdd.map(_packed).repartitionAndSortWithinPartitions(partitions, _by_anchor)

    def emit(records: Iterator[tuple[bytes, tuple]]) -> Iterator[tuple]:
        current, windows = None, []
        for key, (anchor_id, vec_id) in records:
            anchor, turned, kind, _, _, _ = struct.unpack(KEY, key)
            score = LONGEST - turned
            if anchor != current:
                current, windows = anchor, []
            if kind == POSITIVE:
                windows.append([vec_id, score, *window(score, low, high), 0])
                continue
            for w in windows:
                if w[4] < negatives and w[2] <= score <= w[3]:
                    w[4] += 1
                    yield anchor_id, w[0], w[4], vec_id, w[1], score

    mined = stored(spark.createDataFrame(sorted_scores.mapPartitions(emit), MINED), "mined", drop=rows)
    discard(near)
    return mined
