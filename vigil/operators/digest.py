"""Digests of whole columns that do not depend on the order of rows, in one pass and linear in the number of columns.

Each row gives every column a hash of (the whole row, its own value); a column's digest is the sum over all rows. Two columns
that hold equal values in every row have equal digests. Columns that differ in some row differ there in what they add, as the
row's own hash makes equal values of different rows count apart, up to a collision of 64-bit hashes. Sums of a table's parts
add up, so digests can be kept by day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_hashes(df: DataFrame, columns: list[str], keep: list[str] = (), extra: dict[str, Column] | None = None) -> DataFrame:
    """``keep``, ``extra`` and a hash ``_h{i}`` of each column's value (null for null), and ``_row``, a hash of them all."""
    extra = extra or {}
    hashed = df.select(*[F.col(f"`{c}`") for c in keep], *[v.alias(k) for k, v in extra.items()],
                       *[F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(F.col(f"`{c}`"))).alias(f"_h{i}") for i, c in enumerate(columns)])
    at = [F.coalesce(F.col(f"_h{i}"), F.lit(-i - 1)) for i in range(len(columns))]
    return hashed.withColumn("_row", F.xxhash64(*at))


def column_digests(n: int) -> list[Column]:
    """Aggregates over ``column_hashes``: values{i} (not null), least{i} and most{i} (hashes: equal for a constant column), digest{i}.

    A digest is the exact sum of 64-bit hashes, added as two sums of their 32-bit halves and put together once a group: sums of
    decimals would make an object a cell. A group holds up to 2^31 rows; more are an overflow error, sums of groups are decimals."""
    wide, half = T.DecimalType(38, 0), T.DecimalType(20, 0)
    out = []
    for i in range(n):
        h = F.col(f"_h{i}")
        cell = F.xxhash64(F.col("_row"), F.coalesce(h, F.lit(0)), h.isNull())
        high, low = F.sum(F.shiftright(cell, 32)).cast(half), F.sum(cell.bitwiseAND(F.lit(0xFFFFFFFF))).cast(half)
        out += [F.count(h).alias(f"values{i}"), F.min(h).alias(f"least{i}"), F.max(h).alias(f"most{i}"),
                (high * F.lit(1 << 32).cast(T.DecimalType(10, 0)) + low).cast(wide).alias(f"digest{i}")]
    return out


def first_equal(fields: list[T.StructField], digest=lambda i: F.col(f"digest{i}")) -> list[Column]:
    """For each column the number of the first earlier column of its type with an equal digest, or null."""
    out = []
    for j, f in enumerate(fields):
        earlier = [F.when(digest(i).eqNullSafe(digest(j)), F.lit(i)) for i in range(j) if fields[i].dataType == f.dataType]
        out.append(F.coalesce(*earlier) if earlier else F.lit(None).cast("int"))
    return out
