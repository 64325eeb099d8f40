"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def pin(spark: SparkSession) -> SparkSession:
    """Pin the session settings the operators rely on; all are runtime settings.

    UTC makes epoch arithmetic independent of the cluster's zone.  AQE splits
    skewed join partitions and coalesces small ones.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split a hot join key even where the aggregate above then needs its own shuffle.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Chunks of an ordered scan are bounded; keep the common ones out of the spill path.
    spark.conf.set("spark.sql.windowExec.buffer.in.memory.threshold", "65536")
    # Folders are listed in few tasks of many folders each, not in a task for each folder.
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "200")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, taken from ``spark.checkpoint.dir``.

    A machine-local folder is used only when nothing is configured, which is the
    case in tests and on a laptop.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sensorspark-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_in_order(df: DataFrame) -> DataFrame:
    """Like :func:`cut`, and the copy is known to be partitioned and sorted as ``df`` is.

    Spark keeps that knowledge only for plans that are not adaptive, so adaptive execution
    is off while the copy is written, and as it was afterwards.
    """
    spark = df.sparkSession
    shared_dir(spark)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
