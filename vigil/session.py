"""Session helpers: a tuned SparkSession for local runs and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "vigil") -> SparkSession:
    """Return the active session or build a local one with AQE and skew handling on."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VIGIL_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    The setting is read from the session. Only a local-mode session with no
    setting (tests, laptops) gets a fresh private folder; on a cluster an unset
    folder is an error, because a machine-local folder does not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="vigil-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def cut_lineage(df, compression: str | None = None):
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and read it back.

    One pass (``Dataset.checkpoint`` on an unpersisted plan computes it twice:
    once for the eager action, once for the write), and the table has file
    statistics for Catalyst's join planning.  Survives executor loss, unlike
    localCheckpoint.  ``compression`` is the table's codec (none given: the session's); zstd writes less of large tables.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    out = df.write.mode("errorifexists")
    (out if compression is None else out.option("compression", compression)).parquet(path)
    return spark.read.parquet(path)
