"""Global running totals without a single-partition window.

A window with ORDER BY and no PARTITION BY moves every row into one task.
Instead the ordering column is cut into ``n_buckets`` ranges at approximate
quantiles (a bounded list the driver holds), running sums are taken inside each
range in parallel, and per-range offsets come from a table of ``n_buckets`` rows
that is broadcast back.  The result is exact; only the balance of the ranges is
approximate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.text import let
from vigil.session import cut_lineage


def _count_below(v: Column, arr: Column, most: int) -> Column:
    """Number of elements of the ascending ``arr``, which has at most ``most``, strictly below ``v`` (0 for a null array).

    Found by halving steps: the cost a row grows with the logarithm of the number of cut points, which itself grows with the table."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))]).cast("array<int>")

    def search(a):
        return F.aggregate(steps, F.lit(0), lambda below, step: F.when(F.get(a, below + step - 1) < v.cast("double"), below + step).otherwise(below))

    return F.coalesce(let(arr, search), F.lit(0))


def _bounds_array(bounds: list[float]) -> Column:
    return F.array(*[F.lit(float(b)) for b in bounds]) if bounds else F.array().cast("array<double>")


def _bucket_expr(v: Column, bounds: list[float]) -> Column:
    return _count_below(v, _bounds_array(bounds), len(bounds))


def _keys(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


#: Range buckets hold about this many rows each; small inputs are cut into MIN_BUCKETS.
ROWS_PER_BUCKET, MIN_BUCKETS = 500_000, 64


def buckets_for(df: DataFrame) -> int:
    """Number of range buckets for the rows of ``df``, so that a bucket's size does not grow with the input."""
    return max(MIN_BUCKETS, -(-df.count() // ROWS_PER_BUCKET))


def range_bounds(df: DataFrame, order_col: str, bound_by: str | None, n_buckets: int | None = None,
                 accuracy: int | None = None):
    """Approximate quantile cut points of ``order_col``: a sorted list, or a dict of
    lists per ``bound_by`` value.  The driver holds ``n_groups × (n_buckets - 1)``
    numbers, so ``bound_by`` must name a column with a handful of values."""
    n_buckets = n_buckets or buckets_for(df)
    accuracy = accuracy or max(10000, 20 * n_buckets)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    v = F.col(order_col).cast("double")
    if bound_by is None:
        row = df.agg(F.percentile_approx(v, probs, accuracy).alias("b")).collect()[0]
        return sorted(set(row["b"] or []))
    rows = df.groupBy(bound_by).agg(F.percentile_approx(v, probs, accuracy).alias("b")).collect()
    return {r[bound_by]: sorted(set(r["b"] or [])) for r in rows}


def bucket_from_bounds(order_col: str, bound_by: str | None, bounds) -> Column:
    """Range bucket of ``order_col`` for bounds from ``range_bounds`` (equal values share a bucket)."""
    v = F.col(order_col)
    if bound_by is None:
        return _bucket_expr(v, bounds)
    if not bounds:
        return F.lit(0)
    # the group's cut points by one map lookup, then one pass over them
    per_group = F.create_map(*[x for g, b in bounds.items() for x in (F.lit(g), _bounds_array(b))])
    return _count_below(v, per_group[F.col(bound_by)], max(map(len, bounds.values())))


def bucket_column(df: DataFrame, order_col: str, bound_by: str | None, n_buckets: int | None = None, accuracy: int | None = None) -> Column:
    return bucket_from_bounds(order_col, bound_by, range_bounds(df, order_col, bound_by, n_buckets, accuracy))


def running_totals(df: DataFrame, order_col: str, sums: list[str], by=None,
                   n_buckets: int | None = None, accuracy: int | None = None, bound_by: str | None = None,
                   bucket: Column | None = None) -> DataFrame:
    """Add ``cum_<s>`` (inclusive running sum in ``order_col`` order, within ``by``),
    ``total_<s>`` and ``next_<order_col>`` (next value in order, null for the last).

    ``order_col`` must be unique within each ``by`` group (pre-aggregate equal
    values first).  ``by`` is a column or a list of columns.  Range bounds are
    taken per ``bound_by`` (default: ``by`` when it is one column), which must
    have a handful of values.  When ``by`` has more groups than ``bound_by``
    (e.g. per (column, day)), the per-bucket offset table grows with the data
    and is joined by a shuffle instead of a broadcast; each of its window
    partitions still holds at most ``n_buckets`` rows.  A ``bucket`` expression
    from ``bucket_column`` may be passed to reuse bounds across passes over
    the same values.
    """
    by_cols = _keys(by)
    if bound_by is None and len(by_cols) == 1:
        bound_by = by_cols[0]
    if bucket is None:
        bucket = bucket_column(df, order_col, bound_by, n_buckets, accuracy)
    keys = by_cols + ["_bucket"]
    b = df.withColumn("_bucket", bucket)
    w = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = b.select("*", *[F.sum(s).over(w).alias(f"_lc_{s}") for s in sums],
                     F.lead(order_col).over(Window.partitionBy(*keys).orderBy(order_col)).alias("_lnext"))
    # from the window's output: already partitioned by the keys, so no second shuffle of the input
    totals = local.groupBy(*keys).agg(*[F.sum(s).alias(f"_bt_{s}") for s in sums], F.min(order_col).alias("_bmin"))
    wb = Window.partitionBy(*by_cols).orderBy("_bucket")
    wprev = wb.rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.partitionBy(*by_cols)
    offsets = totals.select(
        *keys,
        *[F.coalesce(F.sum(f"_bt_{s}").over(wprev), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(f"_bt_{s}").over(wall).alias(f"total_{s}") for s in sums],
        F.lead("_bmin").over(wb).alias("_nextmin"))
    bounded = set(by_cols) <= ({bound_by} if bound_by else set())
    # With by ⊆ bound_by the offset table has at most n_groups × n_buckets rows: a
    # proven bound, so it is broadcast.  Otherwise it is a regular (shuffle) join.
    out = local.join(F.broadcast(offsets) if bounded else offsets, keys)
    return out.select(
        *[c for c in df.columns],
        *[(F.col(f"_lc_{s}") + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums],
        *[F.col(f"total_{s}") for s in sums],
        F.coalesce(F.col("_lnext"), F.col("_nextmin")).alias(f"next_{order_col}"))


def asof_last(probes: DataFrame, knots: DataFrame, by: str, key: str, payload: list[str],
              n_buckets: int | None = None, accuracy: int | None = None, bounds=None) -> DataFrame:
    """As-of lookup: each probe row gets the ``payload`` columns of the last knot with
    ``knot.key <= probe.key`` in the same ``by`` group (null when there is none).

    Knot keys must be unique within a group.  Probes and knots are cut into the
    same range buckets per ``by`` group; inside a bucket a forward fill over
    (key, knot-before-probe) runs in parallel, and a probe whose bucket holds
    no earlier knot takes the carry of the earlier buckets, from a table of at
    most n_groups × n_buckets rows (broadcast: the bound is the parameter).
    No side is copied, and no group lands whole in one task.  ``bounds`` (from
    ``range_bounds`` per ``by``) reuses cut points already taken on the key axis.
    """
    pl = F.struct(*[F.col(c) for c in payload])
    k = knots.select(F.col(by), F.col(key).cast("double").alias("_key"), F.lit(0).alias("_probe"), pl.alias("_p"))
    pcols = [c for c in probes.columns if c not in (by,)]
    p = probes.select(F.col(by), F.col(key).cast("double").alias("_key"), F.lit(1).alias("_probe"),
                      F.lit(None).cast(k.schema["_p"].dataType).alias("_p"),
                      F.struct(*[F.col(f"`{c}`") for c in pcols]).alias("_row"))
    u = k.withColumn("_row", F.lit(None).cast(p.schema["_row"].dataType)).unionByName(p)
    u = u.withColumn("_bucket", bucket_column(u, "_key", by, n_buckets, accuracy) if bounds is None
                     else bucket_from_bounds("_key", by, bounds))
    w = (Window.partitionBy(by, "_bucket").orderBy("_key", "_probe")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = u.select(by, "_bucket", "_probe", "_row", F.last("_p", ignorenulls=True).over(w).alias("_lp"))
    # the largest knot of each bucket by its key alone, a plain hash aggregate; only the keys carried on fetch their payload
    last_in_bucket = u.groupBy(by, "_bucket").agg(F.max(F.when(F.col("_probe") == 0, F.col("_key"))).alias("_bl"))
    before = last_in_bucket.select(
        by, "_bucket",
        F.last("_bl", ignorenulls=True).over(
            Window.partitionBy(by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)).alias("_key"))
    fetched = k.join(F.broadcast(before.select(by, "_key").distinct()), [by, "_key"]).groupBy(by, "_key").agg(F.first("_p").alias("_carry"))
    carry = before.join(F.broadcast(fetched), [by, "_key"], "left").select(by, "_bucket", "_carry")
    out = (local.filter(F.col("_probe") == 1)
                .join(F.broadcast(carry), [by, "_bucket"])
                .select(by, "_row", F.coalesce("_lp", "_carry").alias("_hit")))
    return out.select(F.col(by), *[F.col(f"_row.`{c}`").alias(c) for c in pcols],
                      *[F.col(f"_hit.`{c}`").alias(c) for c in payload])


def global_position(df: DataFrame, order_col: str, n_buckets: int | None = None) -> DataFrame:
    """0-based position of each row in ``order_col`` order (unique values) plus the row total."""
    one = df.withColumn("_one", F.lit(1).cast("long"))
    rt = running_totals(one, order_col, ["_one"], n_buckets=n_buckets)
    return rt.select(*df.columns, (F.col("cum__one") - 1).alias("position"), F.col("total__one").alias("n_total"))


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``df`` with its 0-based global place in ascending ``order`` (any types, nulls first), without one task for all rows.

    Rows are dealt in ranges and written with the range they fell in (ranges are sampled; writing fixes them), numbered inside
    each, and shifted by the sizes of the ranges before: a table with one row per range, so its window is bounded.
    """
    by = [F.col(f"`{c}`").asc_nulls_first() for c in order]
    fixed = cut_lineage(df.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()))
    sizes = fixed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    shift = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*by)) - 1
    return fixed.withColumn(out, inside).join(F.broadcast(shift), "_range").select(*[F.col(f"`{c}`") for c in df.columns], (F.col(out) + F.col("_before")).alias(out))
