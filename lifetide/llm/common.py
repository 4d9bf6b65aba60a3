"""Helpers shared by the operators: reading tables, shared folders, seeds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the word pattern of the contracts, for ``regexp_*`` functions.
WORD = r"[^\x20\x09-\x0D]+"


#: Words whose hash one task keeps (about 50 MB).
CACHE_WORDS = 300_000


class WordHashes(dict):
    """Word -> 64-bit hash, kept while there are at most ``CACHE_WORDS``."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def key_and_text(docs: DataFrame, null_as: str | None = "") -> DataFrame:
    """``doc_id`` (long) and ``text`` alone, so other columns of the input can
    have any names; a null text becomes ``null_as``."""
    text = F.col("text").cast("string")
    if null_as is not None:
        text = F.coalesce(text, F.lit(null_as))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a local folder is set only
    where that is unset on one machine (tests).  On a cluster that is an error:
    executors would write to disks of their own."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder there that all executors share")
        folder = tempfile.mkdtemp(prefix="lifetide-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, label: str, drop: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage with files that outlive any executor.  ``drop``: an earlier result
    of this function that nothing reads any more; its files are deleted."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/lifetide-{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    if drop is not None:
        discard(drop)
    out = spark.read.schema(schema).parquet(path)
    out.stored_path = path
    return out


def discard(table: DataFrame) -> None:
    """Delete the files of a result of ``stored``."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.stored_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Spark's setting that a query's shuffle files go when it has ended, not when the driver next collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside are deleted as each ends; for
    steps of which each is ``stored`` once and then read from there."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


#: Bits by which rows without a match are left out before a join (some 40 MB broadcast at most).
BITS = 1 << 28


def likely(rows: DataFrame, keys: DataFrame, key: str, met: bool = True) -> DataFrame:
    """The ``rows`` whose ``key``, a 64-bit hash, may be in ``keys``: all that
    have a match and some others, so that a join sends few rows in vain.  The
    first bits of every key are a place in a table of bits.  Not ``met``: the
    others of ``rows``, which have no match."""
    size = max(12, min((8 * keys.count()).bit_length(), BITS.bit_length() - 1))
    place = F.shiftrightunsigned(key, 64 - size).alias("place")
    words = keys.select(place).groupBy(F.expr("shiftright(place, 12)").alias("chunk"), F.expr("int(shiftright(place, 6) & 63)").alias("word"))
    words = words.agg(F.expr("bit_or(shiftleft(1L, int(place & 63)))").alias("bits"))
    chunks = words.groupBy("chunk").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"))
    chunks = chunks.selectExpr("chunk AS bits_chunk", "transform(sequence(0, 63), i -> coalesce(try_element_at(words, i), 0L)) AS bits_words")
    mine = f"shiftrightunsigned({key}, {64 - size})"
    found = rows.join(F.broadcast(chunks), F.expr(f"shiftright({mine}, 12) = bits_chunk"), "inner" if met else "left")
    bit = f"coalesce(getbit(bits_words[int(shiftright({mine}, 6) & 63)], int({mine} & 63)), 0)"
    return found.where(f"{bit} = {int(met)}").select(*rows.columns)


def crc_bucket(column: str, buckets: int):
    """crc32 of the id's decimal text, modulo ``buckets``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(buckets)
