"""Stored tables: sized files, sorted files, and publishing as a whole.

``write_table`` writes the files of one table.  ``publish`` makes a rebuild
atomic: the new files go to a version folder of their own under the table's
path, and only when all are written does an empty marker file name that
version as the current one.  Creating a marker is one step in any file system,
so a reader sees the old rows or the new ones, and a build that fails or is
killed leaves the old ones.  Several tables written below one version folder
(``plans.pipeline.build_all``) are published by one marker, so they always
belong together.

Versions that were published before are kept for readers that still use them
(``keep`` of them); ``drop_unpublished`` removes what killed builds left.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of the markers; readers of files skip names that start so.
MARKERS = "_published"
VERSION_PREFIX = "version-"


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write ``df`` to ``path``, replacing what is there.

    ``partition_by``: one directory per value.  The rows are brought together
    by the ``REBALANCE`` hint, so adaptive execution sizes the files: small
    directories share a task and have one file each, a large one is split over
    several tasks of the advisory size.

    ``sort_by``: the table's files are in order end to end.  Ranges of the sort
    columns are cut at sampled bounds, so a user with a third of all rows is
    split between its days; rows that tie in them are ordered and split by a
    hash of the other columns (only rows equal in every column stay together).
    Adaptive execution joins neighbouring small ones (with ``then`` there are as
    many as a shuffle has).  Row groups then hold short spans of the sort columns and are
    skipped by their statistics.  With both, each directory is in order.
    ``then`` is a step without a shuffle that is made on the sorted rows and
    keeps their order (``expand_runs``: runs of days are ranged and sorted, the
    many days in them only written); it may change the columns, but not those
    of ``partition_by``.
    """
    partition_by, sort_by = partition_by or [], sort_by or []
    if sort_by:
        order = [F.col(c).asc_nulls_first() for c in [*partition_by, *sort_by]]
        rest = [c for c in df.columns if c not in {*partition_by, *sort_by}]
        tie = [F.xxhash64(*rest).asc()] if rest else []
        # Adaptive execution would join ranges by the size of the rows before ``then``, which may make many of each.
        ranges = [int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))] if then is not None else []
        df = df.repartitionByRange(*ranges, *order, *tie).sortWithinPartitions(*order, *tie)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    if then is not None:
        df = then(df)
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def new_version() -> str:
    return f"{VERSION_PREFIX}{uuid.uuid4().hex}"


def publish(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    keep: int = 1,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Write ``df`` as the new version of the table at ``path`` and make it the
    current one; returns the version's folder.  Until then, and if the write
    fails, ``read_published`` gives the rows of before."""
    version = new_version()
    folder = f"{path.rstrip('/')}/{version}"
    try:
        write_table(df, folder, fmt, partition_by, sort_by, then)
    except BaseException:
        delete(df.sparkSession, folder)
        raise
    publish_folder(df.sparkSession, path, version, keep)
    return folder


def publish_folder(spark: SparkSession, path: str, version: str, keep: int = 1) -> None:
    """Make the finished folder ``version`` below ``path`` the current one and
    delete all but ``keep`` of the versions that were current before."""
    base = path.rstrip("/")
    earlier = _markers(spark, base)
    place = int(earlier[-1].split("-", 1)[0]) + 1 if earlier else 1
    fs, marker = _path(spark, f"{base}/{MARKERS}/{place:012d}-{version}")
    fs.mkdirs(marker.getParent())
    if not fs.createNewFile(marker):
        raise RuntimeError(f"{marker} is there already")
    for name in earlier[: max(0, len(earlier) - keep)]:
        delete(spark, f"{base}/{name.split('-', 1)[1]}")
        delete(spark, f"{base}/{MARKERS}/{name}")


def published_folder(spark: SparkSession, path: str) -> str:
    """Folder of the current version of the table (or build) at ``path``."""
    base = path.rstrip("/")
    markers = _markers(spark, base)
    if not markers:
        raise FileNotFoundError(f"nothing is published at {path}")
    return f"{base}/{markers[-1].split('-', 1)[1]}"


def read_published(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current rows of the table at ``path``."""
    return spark.read.format(fmt).load(published_folder(spark, path))


def drop_unpublished(spark: SparkSession, path: str, hours: float = 24.0) -> list[str]:
    """Delete version folders that never were published and that nothing has
    been added to for ``hours`` (a running build is younger)."""
    base = path.rstrip("/")
    named = {m.split("-", 1)[1] for m in _markers(spark, base)}
    fs, folder = _path(spark, base)
    dropped = []
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        name = status.getPath().getName()
        old = status.getModificationTime() / 1000 <= time.time() - hours * 3600
        if name.startswith(VERSION_PREFIX) and name not in named and old:
            delete(spark, f"{base}/{name}")
            dropped.append(name)
    return dropped


def delete(spark: SparkSession, path: str) -> None:
    """Recursively delete ``path`` through the Hadoop FileSystem API."""
    fs, hpath = _path(spark, path)
    fs.delete(hpath, True)


def _path(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _markers(spark: SparkSession, base: str) -> list[str]:
    """Names of the markers, oldest first."""
    fs, folder = _path(spark, f"{base}/{MARKERS}")
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if VERSION_PREFIX in s.getPath().getName())
