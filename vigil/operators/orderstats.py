"""Exact order statistics and most frequent values per column, without one task for a column.

Quantiles are found by rank selection: approximate cut points part each column into range buckets, one counting pass says
how many values each bucket holds, and with that the bucket and the place inside it of every rank asked for. Only the
values of these buckets are sorted, after equal ones have been counted together, so a value that holds a third of the
rows is one row there. The driver holds a number for each (column, bucket) and for each rank, a bound set by parameters.

Most frequent values come from counts per (column, value), combined in the tasks before they are shuffled, and then one
``min_by`` per column; ties go to the least value.

Nulls are no values, and neither is NaN; a column without values has null statistics. A table without rows gives the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.ordered import bucket_from_bounds, buckets_for


def stacked(df: DataFrame, columns, cast: str) -> DataFrame:
    """(column_name, value) of every non-null (and not NaN) cell of ``columns``."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast(cast).alias("value")) for c in columns])
    x = df.select(F.inline(cells)).filter(F.col("value").isNotNull())
    return x.filter(~F.isnan("value")) if cast == "double" else x


def _cut_points(df: DataFrame, columns, n_buckets: int) -> dict[str, list[float]]:
    """Approximate quantiles of each column: one pass, ``n_buckets - 1`` numbers a column."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    value = lambda c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
    row = df.agg(*[F.percentile_approx(value(c), probs, max(10_000, 20 * n_buckets)).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    return {c: sorted(set(row[f"b{i}"] or [])) for i, c in enumerate(columns)}


def quantiles(df: DataFrame, columns, probs, n_buckets: int | None = None) -> DataFrame:
    """(column_name, prob, value) with the linearly interpolated quantile of each numeric column: the value at place
    ``prob * (n - 1)`` of its n sorted values, between two of them in proportion."""
    spark, columns = df.sparkSession, list(columns)
    bounds = _cut_points(df, columns, n_buckets or buckets_for(df))
    cells = stacked(df, columns, "double").withColumn("bucket", bucket_from_bounds("value", "column_name", bounds))
    counts: dict[str, list[tuple[int, int]]] = {c: [] for c in columns}
    for r in cells.groupBy("column_name", "bucket").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["column_name"]].append((r["bucket"], r["n"]))
    wanted = []  # a row for each rank: column, prob, bucket, place in the bucket (from 1), weight of the value
    for c in columns:
        n = sum(k for _, k in counts[c])
        for p in probs if n else ():
            place = p * (n - 1)
            low, share = math.floor(place), place - math.floor(place)
            for rank, weight in ((low, 1 - share), (low + 1, share)):
                if weight:
                    before = 0
                    for bucket, k in sorted(counts[c]):
                        if rank < before + k:
                            wanted.append((c, float(p), bucket, rank - before + 1, weight))
                            break
                        before += k
    schema = "column_name string, prob double, bucket int, place long, weight double"
    ranks = F.broadcast(spark.createDataFrame(wanted, schema))  # two rows for each column and probability
    inside = cells.join(F.broadcast(ranks.select("column_name", "bucket").distinct()), ["column_name", "bucket"], "left_semi")
    alike = inside.groupBy("column_name", "bucket", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("column_name", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    hit = alike.withColumn("upto", upto).join(ranks, ["column_name", "bucket"]).filter((F.col("place") <= F.col("upto")) & (F.col("place") > F.col("upto") - F.col("n")))
    # low + (high - low) * share, so that equal neighbours give their own value exactly
    found = hit.groupBy("column_name", "prob").agg((F.min("value") + (F.max("value") - F.min("value")) * F.max_by("weight", "value")).alias("value"), F.count(F.lit(1)).alias("k"),
                                                   F.min("value").alias("only"))
    found = found.select("column_name", "prob", F.when(F.col("k") == 1, F.col("only")).otherwise(F.col("value")).alias("value"))
    every = F.broadcast(spark.createDataFrame([(c, float(p)) for c in columns for p in probs], "column_name string, prob double"))
    return every.join(found, ["column_name", "prob"], "left")


def value_counts(df: DataFrame, columns, cast: str = "string") -> DataFrame:
    """(column_name, value, n): the number of rows of each value of each column."""
    return stacked(df, columns, cast).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def most_frequent(counts: DataFrame) -> DataFrame:
    """(column_name, n_unique, top, freq) from ``value_counts``; of equally frequent values the least is top."""
    order: Column = F.struct(-F.col("n"), F.col("value"))
    return counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_unique"), F.min_by("value", order).alias("top"), F.max("n").alias("freq"))
