"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

``targets`` gives every source an amount in proportion to its weight, clamps those that would pass their maximum
(epochs times their size), and shares the excess among the others by weight until no source is above its maximum.
``mix`` then repeats each document: whole repetitions for all documents of a source, and one more for those that
come first in a seeded order of the source, as long as the fractional part of the target is not filled. So a
source's amount is off its target by less than one document, and reruns take the same documents.

Sizes are whole numbers. A null source is a source of its own, a null size counts as 0; sources of size 0 get the
target 0. Rows with equal keys (or none) go by a hash of all their columns; rows equal in every column are taken or left
together. Tables without rows give none. A column of ``docs`` that has the name of a result column is left out; others keep their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import WORD, numbered, written

#: Slices of a source's seeded order: sums by slice place the cut, only the slice with the cut is ordered row by row.
SLICES = 4096


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def ranked_weights(docs: DataFrame, source: str, pattern: list[float]) -> DataFrame:
    """Weights by the place of each source in code-point order (null last), the pattern repeated."""
    name = F.col(source)
    ranked = numbered(docs.select(source).distinct(), [name.isNull(), name])
    weights = F.array(*[F.lit(float(w)) for w in pattern])
    return ranked.select(source, F.element_at(weights, (F.col("rank") % len(pattern) + 1).cast("int")).alias("weight"))


def targets(sources: DataFrame, total: float, epochs: float) -> DataFrame:
    """``sources`` (weight, source_size) with ``target``. Each round adds up, over all sources, what the clamped ones
    take and the weight of the others; only these two sums come to the driver. The level only rises, so the rounds end."""
    level, cap = 0.0, epochs * F.col("source_size")
    clamped = lambda x: cap <= F.col("weight") * x
    while True:
        row = sources.agg(F.sum(F.when(clamped(level), cap).otherwise(0.0)).alias("taken"),
                          F.sum(F.when(clamped(level), 0.0).otherwise(F.col("weight"))).alias("weight")).first()
        if not row["weight"]:
            break
        higher = (total - row["taken"]) / row["weight"]
        if higher <= level:
            break
        level = higher
    return sources.withColumn("target", F.least(cap, F.col("weight") * level))


def plan(docs: DataFrame, weights: DataFrame, key: str, source: str, size: str, share: float, epochs: float, seed: int) -> DataFrame:
    """One row per source: its target, its whole repetitions, and where the additional one ends (slice and order number)."""
    rows = written(docs.select(F.col(source).alias("__source"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("__size"), order_number(key, seed).alias("__u"), tie_number(docs).alias("__v"))
                   .withColumn("__slice", slice_of(F.col("__u"))))
    slices = written(rows.groupBy("__source", "__slice").agg(F.sum("__size").alias("slice_size")))
    per_source = slices.groupBy("__source").agg(F.sum("slice_size").alias("source_size"))
    weighed = written(per_source.join(weights.select(F.col(source).alias("__name"), "weight"), F.col("__source").eqNullSafe(F.col("__name")), "left")
                      .select("__source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight")))
    total = share * float(weighed.agg(F.sum("source_size")).first()[0] or 0)
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    aims = targets(weighed, total, epochs).select("__source", "source_size", "target", whole.alias("whole")).withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    aims = written(aims.withColumnRenamed("__source", "__name"))

    running = F.sum("slice_size").over(Window.partitionBy("__source").orderBy("__slice"))
    cut = (slices.withColumn("before", running - F.col("slice_size")).join(aims, F.col("__source").eqNullSafe(F.col("__name")))
           .filter((F.col("before") < F.col("extra")) & (F.col("before") + F.col("slice_size") >= F.col("extra"))).groupBy("__name").agg(F.max(F.struct("__slice", "before", "extra")).alias("cut")))
    # the slice that the cut falls in, in its seeded order: a document is taken while more than half of it fits
    inside = rows.join(cut.select("__name", "cut.*").withColumnRenamed("__slice", "cut_slice"), F.col("__source").eqNullSafe(F.col("__name")) & (F.col("__slice") == F.col("cut_slice")))
    # rows equal in all columns are one unit, so no order among them can matter
    units = inside.groupBy("__name", "before", "extra", "__u", "__v").agg(F.sum("__size").alias("__size"))
    upto = F.col("before") + F.sum("__size").over(Window.partitionBy("__name").orderBy("__u", "__v").rowsBetween(Window.unboundedPreceding, 0))
    last = units.withColumn("upto", upto).filter(F.col("upto") - F.col("__size") / 2 <= F.col("extra")).groupBy("__name").agg(F.max(F.struct("__u", "__v")).alias("cut_at"))
    found = cut.join(last.withColumnRenamed("__name", "__n"), F.col("__name").eqNullSafe(F.col("__n")), "left").select(F.col("__name").alias("__m"), F.col("cut.__slice").alias("cut_slice"), "cut_at")
    return written(aims.join(found, F.col("__name").eqNullSafe(F.col("__m")), "left").select("__name", "source_size", "target", "whole", "extra", "cut_slice", "cut_at"))


def order_number(key: str, seed: int) -> Column:
    """60 bits of the MD5 of seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def tie_number(docs: DataFrame) -> Column:
    """Orders rows with equal keys (or none): a hash of all columns."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def slice_of(u: Column) -> Column:
    return F.pmod(F.shiftright(u, 40), F.lit(SLICES)).cast("int")


def mix(docs: DataFrame, weights: DataFrame, key: str, source: str, size: str, share: float, epochs: float, seed: int = 42) -> DataFrame:
    """``docs`` with source_size, target, copies and taken (size times copies).

    ``share``: the mix in parts of the sum of all sizes. ``weights`` has one row per source: source, weight. A row's
    copies follow from its key and its source's row of the plan, so the documents are joined with one row per source.
    """
    own = [f"`{c}`" for c in docs.columns if c not in ("source_size", "target", "copies", "taken")]
    docs = docs.select(*own)
    p = plan(docs, weights, key, source, size, share, epochs, seed)
    u = order_number(key, seed)
    more = (F.col("__p_extra") > 0) & ((slice_of(u) < F.col("__p_cut_slice")) | ((slice_of(u) == F.col("__p_cut_slice")) & F.coalesce(F.struct(u.alias("__u"), tie_number(docs).alias("__v")) <= F.col("__p_cut_at"), F.lit(False))))
    copies = F.least(F.col("__p_whole") + F.coalesce(more, F.lit(False)).cast("long"), F.lit(int(epochs)))
    p = p.toDF(*[c if c.startswith("__") else f"__p_{c}" for c in p.columns])
    joined = docs.join(p, F.col(source).eqNullSafe(F.col("__name")))
    return joined.select(*own, F.col("__p_source_size").alias("source_size"), F.col("__p_target").alias("target"), copies.alias("copies"), (F.coalesce(F.col(size), F.lit(0)) * copies).alias("taken"))
