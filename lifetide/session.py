"""Session helpers: a local session, and the checkpoint directory taken from
the cluster's ``spark.checkpoint.dir``.  The operators set nothing in the
caller's session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(
    cores: int = 8,
    shuffle_partitions: int | None = None,
    app_name: str = "lifetide",
    min_partition_size: str | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks (UI off, no extra ports).

    ``min_partition_size`` lowers AQE's coalescing floor so that small test
    inputs still spread over all local cores (a cluster keeps its own
    advisory size, typically 64-256 MB)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if min_partition_size:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", min_partition_size)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.
    Only where it is unset on one machine (tests) is ``fallback`` installed, or
    a new local folder; on a cluster that is an error, because executors would
    write to disks of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder there that all executors share")
    fallback = fallback or tempfile.mkdtemp(prefix="lifetide-shared-")
    sc.setCheckpointDir(fallback)
    return fallback
