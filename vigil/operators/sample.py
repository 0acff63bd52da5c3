"""Deterministic sampling and splitting: stratified quota sample, positional half split, hash sample.

Randomness is replaced by a hash order (md5 of the key, then the key) so a
sample is repeatable under any partitioning and any retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.ordered import global_position

# Sample size bounds.
DEFAULT_SAMPLE_SIZE = 20
MIN_SAMPLE_SIZE = 20
MAX_SAMPLE_SIZE = 50


def hash_order(key: str) -> Column:
    return F.md5(F.col(key).cast("string"))


def prepared(df: DataFrame, key: str, stratum: str, numeric: bool = False) -> DataFrame:
    """(key, stratum) of the rows that can be sampled: both present; a ``numeric`` stratum also a number, not NaN, and >= 0."""
    value = F.col(stratum)
    if numeric:
        value = value.try_cast("double")
        value = F.when(~F.isnan(value) & (value >= 0), value)
    return df.select(F.col(key), value.alias(stratum)).filter(F.col(key).isNotNull() & F.col(stratum).isNotNull())


def stratum_quotas(clean: DataFrame, stratum: str, size: int) -> DataFrame:
    """(stratum, quota, row_count): an even share of the slots left for each stratum in ascending order, at least one
    while slots last, never more than the stratum has.

    At most ``size`` strata can get a slot, since each gets one; so one array of that many counts holds all that matter.
    """
    counts = clean.groupBy(stratum).agg(F.count(F.lit(1)).alias("n")).orderBy(stratum).limit(size)
    state = "struct<slots:bigint,strata:bigint,quotas:array<bigint>>"
    one = counts.agg(F.sort_array(F.collect_list(F.struct(F.col(stratum), "n"))).alias("c"), F.least(F.sum("n"), F.lit(size)).alias("row_count"))

    def give(acc, x):
        share = F.greatest(F.lit(1), F.floor(acc["slots"] / acc["strata"]))
        quota = F.when(acc["slots"] > 0, F.least(x["n"], share)).otherwise(F.lit(0)).cast("bigint")
        return F.struct((acc["slots"] - quota).alias("slots"), (acc["strata"] - 1).alias("strata"),
                        F.concat(acc["quotas"], F.array(quota)).alias("quotas")).cast(state)

    start = F.struct(F.col("row_count").alias("slots"), F.size("c").cast("bigint").alias("strata"), F.array().cast("array<bigint>").alias("quotas")).cast(state)
    quotas = F.aggregate("c", start, give, lambda acc: acc["quotas"])
    return one.select("row_count", F.inline(F.arrays_zip(F.col(f"c.`{stratum}`").alias(stratum), quotas.alias("quota")))).select(stratum, "quota", "row_count")


def stratified_sample(df: DataFrame, key: str, stratum: str, size: int = DEFAULT_SAMPLE_SIZE, min_size: int = MIN_SAMPLE_SIZE,
                      max_size: int = MAX_SAMPLE_SIZE, numeric: bool = False, ordered: bool = False) -> DataFrame:
    """Quota sample of ``size`` rows (clamped to [min_size, max_size]) across strata, topped up from the rest;
    ``ordered``: by stratum, then key.

    Nothing is collected. Per-stratum picks are a row_number <= k filter, which Spark turns into a partial top-k before
    the shuffle, so a hot stratum never lands whole in one task; the top-up is the first ``size`` rows of the rest in
    hash order, cut to the slots that the quotas left. Quotas and picks have at most ``size`` rows each (broadcast).
    """
    size = max(min_size, min(max_size, int(size)))
    clean = prepared(df, key, stratum, numeric)
    quotas = stratum_quotas(clean, stratum, size)
    h = hash_order(key)
    best = F.row_number().over(Window.partitionBy(stratum).orderBy(h, F.col(key)))
    picked = (clean.withColumn("_rn", best).filter(F.col("_rn") <= size).join(F.broadcast(quotas), stratum)
              .filter(F.col("_rn") <= F.col("quota")).select(key, stratum))
    left = quotas.agg((F.max("row_count") - F.sum("quota")).alias("_left"))
    rest = (unsampled(clean, F.broadcast(picked), key).withColumn("_h", h).orderBy("_h", key).limit(size)
            .withColumn("_nth", F.row_number().over(Window.orderBy("_h", key))).join(F.broadcast(left), F.col("_nth") <= F.col("_left")).select(key, stratum))
    out = picked.unionByName(rest)
    return out.orderBy(stratum, key) if ordered else out


def half_split(df: DataFrame, order_col: str, overlap: bool = True) -> DataFrame:
    """Split rows by position in ``order_col`` order at n = rows // 2 into 'train' / 'test'.

    With ``overlap`` the row at position n is in both halves (label-inclusive
    slicing); without it, positions < n train and ≥ n test.
    """
    pos = global_position(df, order_col)
    n = F.floor(F.col("n_total") / 2)
    p = F.col("position")
    if overlap:
        halves = (F.when(p < n, F.array(F.lit("train")))
                   .when(p == n, F.array(F.lit("train"), F.lit("test")))
                   .otherwise(F.array(F.lit("test"))))
    else:
        halves = F.when(p < n, F.array(F.lit("train"))).otherwise(F.array(F.lit("test")))
    return pos.select(*df.columns, F.explode(halves).alias("half"))


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows in hash order of ``key`` (top-k: per-partition top n, then a merge)."""
    return df.orderBy(hash_order(key), F.col(key)).limit(n)


def top_k(df: DataFrame, order_cols: list, k: int) -> DataFrame:
    return df.orderBy(*order_cols).limit(k)


def unsampled(df: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` not in ``sample`` (anti join on the row key)."""
    return df.join(sample.select(key), key, "left_anti")
