"""Readers for the test tables (one parquet file per table under an sf folder)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def source_key(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """A digest of the files of the tables as they are now: paths, lengths and modification times, by the path's own file system."""
    told = []
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        parts = fs.listStatus(path) if fs.getFileStatus(path).isDirectory() else [fs.getFileStatus(path)]
        told += sorted(f"{s.getPath()}:{s.getLen()}:{s.getModificationTime()}" for s in parts)
    return hashlib.sha256("\n".join(told).encode()).hexdigest()[:24]
