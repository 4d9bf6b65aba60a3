"""Quality by compression against good and bad dictionaries.

One zstandard dictionary is trained on text labelled good and one on text
labelled bad.  A text is cut into blocks of ``BLOCK`` bytes and every block is
compressed with either; with the summed sizes g and b and the text's n bytes
its difference is ``(b - g + PRIOR m) / (n + PRIOR)``, where m is the mean
difference of the calibration texts.  A logistic curve fitted to other
labelled texts, weighted to the labels' class frequencies, turns the
difference into the score: the probability of label 1.  The curve's level and
slope go from those of short texts to those of long ones as ``exp(-n /
SHORT)`` falls, since the difference of a short text is noisier; the
difference is limited below where good texts end, so that far outliers do not
bend the curve.

Learning takes at most ``DICTIONARY_ROWS`` + ``CALIBRATION_ROWS`` labelled
texts of each class, the first by a hash of the id, and up to
``BLOCKS_PER_TEXT`` blocks spread over each whole text for the dictionaries;
everything else covers all rows.  Only blocks and sizes reach the driver, and
only the ids of the sample (bounded by these parameters) are broadcast.

``train`` takes ``docs (doc_id, text)`` and ``labels (doc_id, quality)``;
``score`` returns ``doc_id, score`` for every row of ``docs``, and
``keep`` the rows at or above a threshold with all their columns.  A null text
is empty and scores as the mean difference does; null ids and repeated rows
are scored like others; labels that are null, neither 0 nor 1, or without a
document are ignored; an id labelled twice counts twice.  With labels of one
class or none the score is the mean label (0.5 without any).  Other columns
are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifetide.llm.bpe import slices
from lifetide.llm.common import key_and_text

BLOCK = 256
LEVEL = 3
DICTIONARY_BYTES = 64 << 10
DICTIONARY_ROWS = 1500
CALIBRATION_ROWS = 1500
BLOCKS_PER_TEXT = 16
#: Bytes that stand for what is known before a text is read.
PRIOR = 20.0
#: Length in bytes by which a text stops counting as short.
SHORT = 100.0
#: Texts of this length or more place the limits of the difference.
LONG = 500


@dataclass(frozen=True)
class Model:
    good: bytes | None
    bad: bytes | None
    mean: float = 0.0
    low: float = 0.0
    high: float = 0.0
    curve: tuple[float, ...] = ()
    #: Score of every text where there is nothing to tell the classes by.
    constant: float = 0.5


def blocks(text: str | None) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; raw content where there are too few samples to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Sizes:
    """Summed compressed sizes of a text's blocks under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        def compressor(content: bytes):
            data = zstandard.ZstdCompressionDict(content)
            data.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False).compress

        self.good, self.bad = compressor(good), compressor(bad)

    def __call__(self, text: str | None) -> tuple[int, int, int]:
        parts = blocks(text)
        return sum(len(self.good(p)) for p in parts), sum(len(self.bad(p)) for p in parts), sum(map(len, parts))


def difference(sizes: np.ndarray, mean: float) -> np.ndarray:
    good, bad, raw = sizes.T
    return (bad - good + PRIOR * mean) / (raw + PRIOR)


def features(sizes: np.ndarray, mean: float, low: float, high: float) -> np.ndarray:
    """The curve's inputs: the difference, scaled to -1 at ``low`` and 0 at
    ``high``, for long and for short texts, and both levels."""
    z = (difference(sizes, mean) - high) / max(high - low, 1e-9)
    short = np.exp(-sizes[:, 2] / SHORT)
    return np.stack([np.ones(len(z)), np.clip(z, -1, 1) * (1 - short), np.clip(z, -4, 1) * short, short], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients of the weighted, slightly ridged logistic fit (Newton)."""
    beta = np.zeros(x.shape[1])
    for _ in range(200):
        p = probability(x, beta)
        gradient = x.T @ (weight * (y - p)) - ridge * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        largest = np.abs(step).max()
        beta += step * min(1.0, 4.0 / max(largest, 1e-12))
        if largest < 1e-9:
            break
    return beta


def probability(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))


def sizes_of(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, good, bad, raw`` of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad)
        for batch in batches:
            for part in slices(batch):
                found = [sizes(t) for t in part.column(1).to_pylist()]
                columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "good", "bad", "raw"])

    return key_and_text(docs).mapInArrow(run, "doc_id long, good long, bad long, raw long")


def spread_blocks(docs: DataFrame) -> DataFrame:
    """``doc_id, blocks``: up to ``BLOCKS_PER_TEXT`` blocks spread over each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                taken = []
                for text in part.column(1).to_pylist():
                    parts = blocks(text)
                    at = sorted({int(i) for i in np.linspace(0, len(parts) - 1, min(BLOCKS_PER_TEXT, len(parts)))})
                    taken.append([parts[i] for i in at])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(taken, pa.list_(pa.binary()))], ["doc_id", "blocks"])

    return key_and_text(docs).mapInArrow(run, "doc_id long, blocks array<binary>")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.where("quality IN (0, 1) AND doc_id IS NOT NULL")
    marked = marked.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct(), "doc_id")
    count = {r["quality"]: r["n"] for r in marked.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(count) != {0, 1}:
        share = float(next(iter(count), 0.5))
        return Model(None, None, constant=share)
    chosen: dict[int, list[tuple[int, int]]] = {0: [], 1: []}
    for quality in (0, 1):
        rows = marked.where(F.col("quality") == quality).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id")
        ids = [r["doc_id"] for r in rows.limit(DICTIONARY_ROWS + CALIBRATION_ROWS).collect()]
        # Every second id is for the dictionary, so few labels still leave some for the curve.
        chosen[0] += [(i, quality) for i in ids[::2]]
        chosen[1] += [(i, quality) for i in ids[1::2] or ids]
    spark = docs.sparkSession

    def of(part: int) -> DataFrame:
        ids = spark.createDataFrame(chosen[part], "doc_id long, quality int")
        return key_and_text(docs).join(F.broadcast(ids), "doc_id")

    samples: dict[int, list[bytes]] = {0: [], 1: []}
    taken = spread_blocks(of(0)).join(F.broadcast(spark.createDataFrame(chosen[0], "doc_id long, quality int")), "doc_id")
    for r in sorted(taken.select("doc_id", "quality", "blocks").collect(), key=lambda r: (r["doc_id"], r["quality"], r["blocks"])):
        samples[r["quality"]] += [bytes(b) for b in r["blocks"]]
    model = Model(dictionary(samples[1]), dictionary(samples[0]))
    if not model.good or not model.bad:
        return Model(None, None, constant=count[1] / (count[0] + count[1]))
    measured = sizes_of(of(1), model).join(F.broadcast(spark.createDataFrame(chosen[1], "doc_id long, quality int")), "doc_id")
    rows = np.array(sorted((r["doc_id"], r["quality"], r["good"], r["bad"], r["raw"]) for r in measured.collect()), float)
    y, sizes = rows[:, 1], rows[:, 2:]
    weight = np.where(y == 1, count[1] / max(1, (y == 1).sum()), count[0] / max(1, (y == 0).sum()))
    weight *= len(y) / weight.sum()
    mean = float(np.average(difference(sizes, 0.0), weights=weight))
    good = y == 1
    x = difference(sizes[good & (sizes[:, 2] >= LONG)] if (good & (sizes[:, 2] >= LONG)).any() else sizes[good], mean)
    first, middle = np.quantile(x, [0.01, 0.5])
    low, high = float(2 * first - middle), float(middle)
    curve = logistic(features(sizes, mean, low, high), y, weight)
    return Model(model.good, model.bad, mean, low, high, tuple(curve.tolist()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""
    if model.good is None:
        return key_and_text(docs).select("doc_id", F.lit(model.constant).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad)
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores(model, sizes, part.column(1).to_pylist()))], ["doc_id", "score"])

    return key_and_text(docs).mapInArrow(run, "doc_id long, score double")


def scores(model: Model, sizes: Sizes, texts: list[str | None]) -> np.ndarray:
    found = np.array([sizes(t) for t in texts], float).reshape(-1, 3)
    return probability(features(found, model.mean, model.low, model.high), np.array(model.curve))


def keep(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of ``docs``, whole, whose score reaches ``threshold``."""
    if model.good is None:
        return docs if model.constant >= threshold else docs.limit(0)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad)
        for batch in batches:
            for part in slices(batch):
                kept = scores(model, sizes, part.column(at).to_pylist()) >= threshold
                yield part.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
