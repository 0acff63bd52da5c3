"""Helpers shared by the operators: shared scratch tables, Arrow column functions, ragged numpy gathers."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import checkpoint_dir

#: Words of the contracts: runs of anything but ASCII space and \t \n \v \f \r.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Bytes of text that a Python step handles at once; batches are cut to it, single texts may be longer.
CHUNK_BYTES = 4_000_000


def scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def written(df: DataFrame, partition_by: str | None = None, compression: str | None = None) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once, survives lost executors."""
    path = f"{scratch_root(df.sparkSession)}/{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if compression:
        w = w.option("compression", compression)
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables; call it once the results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(key: str | Column) -> Column:
    """True for the rows that no model learns from: crc32 of the id as text, modulo 3, is 1 (a null id counts as the empty text)."""
    c = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def numbered(df: DataFrame, order: list[Column], out: str = "rank") -> DataFrame:
    """``df`` (small rows) with its 0-based global position in ``order``, without one task for all rows.

    Rows are range-partitioned and written with the partition they fell in (the ranges are sampled, so they
    are fixed by writing them), numbered inside each partition, and shifted by the counts of the partitions
    before, a table with one row per partition.
    """
    part, cnt, base = "__part", "__cnt", "__base"
    keyed = df.select("*", *[c.alias(f"__o{i}") for i, c in enumerate(order)])
    by = [F.col(f"__o{i}").asc_nulls_first() for i in range(len(order))]
    fixed = written(keyed.repartitionByRange(*by).withColumn(part, F.spark_partition_id()))
    counts = fixed.groupBy(part).agg(F.count(F.lit(1)).alias(cnt))
    offsets = counts.select(part, (F.sum(cnt).over(Window.orderBy(part)) - F.col(cnt)).alias(base))
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*by)) - 1
    return fixed.withColumn(out, inside).join(offsets, part).withColumn(out, F.col(out) + F.col(base)).select(*df.columns, out)


def arrow_columns(df: DataFrame, inputs: list[str], outputs: T.StructType, make: Callable[[], Callable], limit: int | None = None) -> DataFrame:
    """``df`` with the columns ``outputs``, computed from whole Arrow batches of ``inputs`` and no shuffle.

    ``make()`` runs once in each task and returns a function from the input arrays to the output arrays.
    An output replaces a column of ``df`` that has its name. ``limit``: bytes of text handled at once, if not CHUNK_BYTES.
    """
    keep = [c for c in df.columns if c not in outputs.fieldNames()]
    need = list(dict.fromkeys([*keep, *inputs]))
    schema = T.StructType([df.schema[c] for c in keep] + list(outputs))

    def run(batches):
        fn = make()
        for batch in batches:
            for rows in cut_batch(batch, inputs, limit):
                cols = fn(*[rows.column(need.index(c)) for c in inputs])
                yield pa.RecordBatch.from_arrays([rows.column(i) for i, c in enumerate(need) if c in keep] + cols, names=schema.fieldNames())

    return df.select(*need).mapInArrow(run, schema)


def cut_batch(batch: pa.RecordBatch, inputs: list[str], limit: int | None = None):
    """The batch in slices of about ``limit`` (CHUNK_BYTES) bytes of its text columns; no text is cut."""
    size = np.zeros(batch.num_rows, np.int64)
    for c in inputs:
        col = batch.column(batch.schema.get_field_index(c))
        if pa.types.is_string(col.type) or pa.types.is_binary(col.type):
            off = np.frombuffer(col.buffers()[1], np.int32)[col.offset: col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int32)
            size += np.diff(off)
    start, block = 0, np.cumsum(size) // (limit or CHUNK_BYTES)
    for end in [*np.flatnonzero(np.diff(block)) + 1, batch.num_rows]:
        if end > start:
            yield batch.slice(start, end - start)
        start = end


def texts_of(col: pa.Array) -> list[str]:
    """The texts of an Arrow column, null as empty."""
    return [t or "" for t in col.to_pylist()]


def offsets(lens: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lens)])


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the concatenation of the ranges [start, start + len)."""
    total = int(lens.sum())
    return np.arange(total) + np.repeat(starts - offsets(lens)[:-1], lens)


class Vocabulary(dict):
    """Gives each new key the next number; ``fresh`` lists the keys that are new since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.fresh = []

    def __missing__(self, key):
        self[key] = n = len(self)
        self.fresh.append(key)
        return n
