"""Column drift between a reference and a current table.

* categorical columns: Jensen-Shannon distance (natural log, sqrt of the
  divergence) of the value frequencies; nulls are left out;
* numeric columns: Wasserstein-1 distance of the empirical distributions divided
  by max(population std of the reference, 0.001).

A column drifts when its score ≥ threshold (0.1).  All columns of one kind are
stacked into (column_name, value) and handled by one grouped job.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.ordered import asof_last, bucket_column, bucket_from_bounds, range_bounds, running_totals
from vigil.session import cut_lineage

# Drift threshold and the floor of the normalising std.
DRIFT_THRESHOLD = 0.1
STD_FLOOR = 0.001
DATASET_DRIFT_SHARE = 0.5
LN2 = math.log(2.0)


def _stack(df: DataFrame, columns, cast: str, keep=()) -> DataFrame:
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS {cast})" for c in columns)
    return df.selectExpr(*[f"`{k}`" for k in keep], f"stack({len(columns)}, {pairs}) AS (column_name, value)")


def _valid(cast: str):
    v = F.col("value")
    return v.isNotNull() & (~F.isnan(v) if cast == "double" else F.lit(True))


def _side_counts(ref: DataFrame, cur: DataFrame, columns, cast: str) -> DataFrame:
    r = _stack(ref, columns, cast).filter(_valid(cast)).select("column_name", "value", F.lit(1).alias("_r"))
    c = _stack(cur, columns, cast).filter(_valid(cast)).select("column_name", "value", F.lit(0).alias("_r"))
    return (r.unionByName(c).groupBy("column_name", "value")
             .agg(F.sum("_r").cast("long").alias("nr"), F.sum(1 - F.col("_r")).cast("long").alias("nc")))


def _result(scores: DataFrame, columns, stattest: str, threshold: float) -> DataFrame:
    """One row for every column asked for; where a side has no value there is no score, and no verdict."""
    names = F.broadcast(scores.sparkSession.createDataFrame([(c,) for c in columns], "column_name string"))
    return names.join(scores, "column_name", "left").select(
        "column_name", F.lit(stattest).alias("stattest"), "drift_score", F.lit(threshold).alias("threshold"),
        (F.col("drift_score") >= threshold).alias("drift_detected"))


def categorical_drift(ref: DataFrame, cur: DataFrame, columns, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    return categorical_drift_of_counts(_side_counts(ref, cur, columns, "string"), columns, threshold)


def categorical_drift_of_counts(counts: DataFrame, columns, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """The same from counts (column_name, value, nr, nc): rows of each value in the reference and in the current table."""
    totals = counts.groupBy("column_name").agg(F.sum("nr").alias("tr"), F.sum("nc").alias("tc")).filter("tr > 0 AND tc > 0")
    # one row per column: a bound fixed by the column list
    j = counts.join(F.broadcast(totals), "column_name")
    p, q = F.col("nr") / F.col("tr"), F.col("nc") / F.col("tc")
    m = (p + q) / 2
    term = (F.when(p > 0, p * F.log(p / m)).otherwise(F.lit(0.0))
            + F.when(q > 0, q * F.log(q / m)).otherwise(F.lit(0.0)))
    scores = j.groupBy("column_name").agg(F.sqrt(F.greatest(F.sum(term) / 2, F.lit(0.0))).alias("drift_score"))
    return _result(scores, columns, "jensen_shannon", threshold)


def numeric_drift(ref: DataFrame, cur: DataFrame, columns, threshold: float = DRIFT_THRESHOLD,
                  n_buckets: int | None = None) -> DataFrame:
    """Normed Wasserstein distance per numeric column.

    W = Σ |F_ref(v_i) − F_cur(v_i)| · (v_{i+1} − v_i) over the merged distinct
    values; the CDFs are exact running sums from ``running_totals`` (range
    buckets, no single-task window).  The distinct-value table is written to the
    checkpoint folder once; the reference's mean and std come from it too.
    """
    return numeric_drift_of_counts(cut_lineage(_side_counts(ref, cur, columns, "double")), columns, threshold, n_buckets)


def numeric_drift_of_counts(vals: DataFrame, columns, threshold: float = DRIFT_THRESHOLD, n_buckets: int | None = None) -> DataFrame:
    """The same from counts (column_name, value, nr, nc), a table that is read several times."""
    rt = running_totals(vals, "value", ["nr", "nc"], by="column_name", n_buckets=n_buckets)
    contrib = (F.abs(F.try_divide(F.col("cum_nr"), F.col("total_nr")) - F.try_divide(F.col("cum_nc"), F.col("total_nc")))
               * (F.col("next_value") - F.col("value")))
    w = rt.groupBy("column_name").agg(F.coalesce(F.sum(F.when(F.col("next_value").isNotNull(), contrib)),
                                                 F.lit(0.0)).alias("w"),
                                      F.max("total_nr").alias("tr"), F.max("total_nc").alias("tc"))
    means = vals.groupBy("column_name").agg(F.try_divide(F.sum(F.col("nr") * F.col("value")), F.sum("nr")).alias("mean"))
    off = F.col("value") - F.col("mean")
    std = (vals.join(F.broadcast(means), "column_name").groupBy("column_name")
           .agg(F.sqrt(F.try_divide(F.sum(F.col("nr") * off * off), F.sum("nr"))).alias("sd")))
    scores = (w.filter((F.col("tr") > 0) & (F.col("tc") > 0)).join(std, "column_name")
               .select("column_name", (F.col("w") / F.greatest(F.col("sd"), F.lit(STD_FLOOR))).alias("drift_score")))
    return _result(scores, columns, "wasserstein_normed", threshold)


def drift_table(ref: DataFrame, cur: DataFrame, numeric, categorical, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    parts = []
    if numeric:
        parts.append(numeric_drift(ref, cur, numeric, threshold))
    if categorical:
        parts.append(categorical_drift(ref, cur, categorical, threshold))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_share(table: DataFrame, dataset_share: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """One row: n_columns, n_drifted_columns, share_of_drifted_columns (null without columns), dataset_drift."""
    return (table.agg(F.count(F.lit(1)).alias("n_columns"),
                      F.count_if("drift_detected").alias("n_drifted_columns"))
                 .withColumn("share_of_drifted_columns", F.try_divide(F.col("n_drifted_columns"), F.col("n_columns")))
                 .withColumn("dataset_drift", F.coalesce(F.col("share_of_drifted_columns") >= dataset_share, F.lit(False))))


def categorical_drift_by_day(ref: DataFrame, cur: DataFrame, columns, ts: str,
                             threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Jensen-Shannon distance of each day of ``cur`` against the whole reference, per column.

    Only values seen on both sides need a join; the mass of values seen on one
    side only enters in closed form (each contributes p·ln 2), so reference
    values are never copied per day.
    """
    rs = _stack(ref, columns, "string").filter(_valid("string"))
    rc = rs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("nr"))
    cs = (_stack(cur.withColumn("data_date", F.to_date(ts)), columns, "string", keep=("data_date",))
          .filter(_valid("string")))
    return categorical_drift_by_day_of_counts(rc, cs.groupBy("data_date", "column_name", "value").agg(F.count(F.lit(1)).alias("nc")), threshold)


def categorical_drift_by_day_of_counts(rc: DataFrame, cc: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """The same from counts: of the reference (column_name, value, nr) and by day (data_date, column_name, value, nc)."""
    rt = rc.groupBy("column_name").agg(F.sum("nr").alias("tr"))
    ct = cc.groupBy("data_date", "column_name").agg(F.sum("nc").alias("tc"))
    both = (cc.join(rc, ["column_name", "value"])
              .join(F.broadcast(rt), "column_name"))
    # compute the per-(day, column) sums after attaching the day totals
    both = both.join(ct, ["data_date", "column_name"])
    p = F.col("nr") / F.col("tr")
    q = F.col("nc") / F.col("tc")
    s = both.groupBy("data_date", "column_name").agg(
        F.sum(p * F.log(2 * p / (p + q)) + q * F.log(2 * q / (p + q))).alias("s_both"),
        F.sum(p).alias("p_both"), F.sum(q).alias("q_both"))
    full = (ct.join(F.broadcast(rt), "column_name").join(s, ["data_date", "column_name"], "left")
              .select("data_date", "column_name",
                      F.coalesce("s_both", F.lit(0.0)).alias("s_both"),
                      F.coalesce("p_both", F.lit(0.0)).alias("p_both"),
                      F.coalesce("q_both", F.lit(0.0)).alias("q_both")))
    jsd = (F.col("s_both") + F.lit(LN2) * ((1 - F.col("p_both")) + (1 - F.col("q_both")))) / 2
    scores = full.select("data_date", "column_name", F.sqrt(F.greatest(jsd, F.lit(0.0))).alias("drift_score"))
    return scores.select("*", F.lit("jensen_shannon").alias("stattest"), F.lit(threshold).alias("threshold"),
                         (F.col("drift_score") >= threshold).alias("drift_detected"))


def _reference_knots(rv: DataFrame, n_buckets: int | None, bounds=None) -> DataFrame:
    """Distinct reference values (column_name, value, nr) → the CDF ``F`` and its
    integral ``G(v) = ∫_{-inf}^{v} F_ref(x) dx`` at each value: two exact running
    sums over the same range buckets."""
    bucket = (bucket_column(rv, "value", "column_name", n_buckets) if bounds is None
              else bucket_from_bounds("value", "column_name", bounds))
    r1 = running_totals(rv, "value", ["nr"], by="column_name", bucket=bucket)
    cdf = F.col("cum_nr") / F.col("total_nr")
    seg = r1.select("column_name", "value", cdf.alias("F"),
                    F.coalesce(cdf * (F.col("next_value") - F.col("value")), F.lit(0.0)).alias("seg"))
    r2 = running_totals(seg, "value", ["seg"], by="column_name", bucket=bucket)
    return r2.select("column_name", "value", "F", (F.col("cum_seg") - F.col("seg")).alias("G"))


def _weighted_std(rv: DataFrame) -> DataFrame:
    """Population std per column from (value, count) pairs, two-pass (mean first)."""
    mean = rv.groupBy("column_name").agg((F.sum(F.col("nr") * F.col("value")) / F.sum("nr")).alias("mu"),
                                          F.sum("nr").alias("n"))
    # one row per column: a bound fixed by the column list
    return (rv.join(F.broadcast(mean), "column_name")
              .groupBy("column_name")
              .agg(F.sqrt(F.sum(F.col("nr") * (F.col("value") - F.col("mu")) ** 2) / F.max("n")).alias("sd")))


def numeric_drift_by_day(ref: DataFrame, cur: DataFrame, columns, ts: str,
                         threshold: float = DRIFT_THRESHOLD, n_buckets: int | None = None) -> DataFrame:
    """``numeric_drift_by_day_sided`` for a reference and a current table given apart."""
    both = (ref.withColumn("_ref", F.lit(True))
               .unionByName(cur.withColumn("_ref", F.lit(False))))
    return numeric_drift_by_day_sided(both, F.col("_ref"), columns, ts, threshold, n_buckets)


def numeric_drift_by_day_sided(df: DataFrame, is_reference, columns, ts: str,
                               threshold: float = DRIFT_THRESHOLD, n_buckets: int | None = None) -> DataFrame:
    """Normed Wasserstein distance of each day of ``cur`` against the whole reference, per column.

    The reference is never copied per day.  With G the integral of the
    reference CDF, day values y_1 < … < y_k, day CDF c_j at y_j, and m_j the
    point where the reference CDF reaches c_j (clamped to [y_j, y_{j+1}]):

        W = Σ_j 2·G(y_j) − Σ_{j<k} 2·G(m_j) + Σ_{j<k} c_j·(2·m_j − y_j − y_{j+1})
            + r_max − y_k − G(r_max)

    Each term needs one as-of lookup in the reference knots (on the CDF axis
    for m_j, on the value axis for G), done by ``asof_last`` in parallel range
    buckets.  Day CDFs are exact running sums per (column, day).
    """
    # one aggregation pass over both sides (one scan of the source when both come
    # from one table): distinct (column, side, day, value) counts
    side = df.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{ts}`"),
                     F.coalesce(is_reference, F.lit(True)).alias("_ref"))
    side = side.withColumn("_d", F.when(~F.col("_ref"), F.to_date(F.col(f"`{ts}`"))))
    both = (_stack(side, columns, "double", keep=("_ref", "_d")).filter(_valid("double"))
            .groupBy("column_name", "_ref", "_d", "value").agg(F.count(F.lit(1)).alias("n")))
    vals = cut_lineage(both)
    rv = vals.filter("_ref").select("column_name", "value", F.col("n").alias("nr"))
    cv = vals.filter(~F.col("_ref")).select("column_name", F.col("_d").alias("data_date"), "value",
                                             F.col("n").alias("nc"))
    return numeric_drift_by_day_of_counts(rv, cv, threshold, n_buckets)


def numeric_drift_by_day_of_counts(rv: DataFrame, cv: DataFrame, threshold: float = DRIFT_THRESHOLD, n_buckets: int | None = None) -> DataFrame:
    """The same from counts: of the reference (column_name, value, nr) and by day (column_name, data_date, value, nc)."""
    # one set of value-axis cut points (over both sides) for every value-ordered step below
    vb = range_bounds(rv.select("column_name", "value").unionByName(cv.select("column_name", "value")), "value", "column_name", n_buckets)
    knots = cut_lineage(_reference_knots(rv, n_buckets, vb))
    rstats = (knots.groupBy("column_name")
                   .agg(F.max("value").alias("r_max"), F.max_by("G", "value").alias("g_max")))
    std = _weighted_std(rv)
    dk = running_totals(cv, "value", ["nc"], by=["column_name", "data_date"], bound_by="column_name",
                        bucket=bucket_from_bounds("value", "column_name", vb))
    dk = cut_lineage(dk.select("column_name", "data_date", "value", "next_value",
                               (F.col("cum_nc") / F.col("total_nc")).alias("c")))
    # m_j: first reference knot with F >= c_j, i.e. the last knot with -F <= -c_j
    inner = dk.filter(F.col("next_value").isNotNull())
    q = asof_last(inner.withColumn("_neg", -F.col("c")),
                  knots.select("column_name", (-F.col("F")).alias("_neg"), F.col("value").alias("q")),
                  "column_name", "_neg", ["q"], n_buckets=n_buckets)
    m = F.least(F.greatest(F.col("q"), F.col("value")), F.col("next_value"))
    # read by three jobs (the G lookup's bounds, the lookup, the linear terms)
    q = cut_lineage(q.select("column_name", "data_date", "value", "next_value", "c", m.alias("m")))
    linear = q.select("column_name", "data_date",
                      (F.col("c") * (2 * F.col("m") - F.col("value") - F.col("next_value"))).alias("part"))
    points = (dk.select("column_name", "data_date", F.col("value").alias("x"), F.lit(2.0).alias("wt"))
                .unionByName(q.select("column_name", "data_date", F.col("m").alias("x"), F.lit(-2.0).alias("wt"))))
    g = asof_last(points, knots.select("column_name", F.col("value").alias("x"), F.col("value").alias("r"),
                                       F.col("F").alias("fr"), F.col("G").alias("gr")),
                  "column_name", "x", ["r", "fr", "gr"], bounds=vb)
    g_at = F.coalesce(F.col("gr") + F.col("fr") * (F.col("x") - F.col("r")), F.lit(0.0))
    parts = g.select("column_name", "data_date", (F.col("wt") * g_at).alias("part")).unionByName(linear)
    # one row per column: a bound fixed by the column list
    tail = (dk.groupBy("column_name", "data_date").agg(F.max("value").alias("y_k"))
              .join(F.broadcast(rstats), "column_name")
              .select("column_name", "data_date", (F.col("r_max") - F.col("y_k") - F.col("g_max")).alias("part")))
    w = parts.unionByName(tail).groupBy("column_name", "data_date").agg(F.sum("part").alias("w"))
    scores = w.join(F.broadcast(std), "column_name").select(
        "data_date", "column_name", (F.greatest(F.col("w"), F.lit(0.0)) / F.greatest(F.col("sd"), F.lit(STD_FLOOR))).alias("drift_score"))
    return scores.select("*", F.lit("wasserstein_normed").alias("stattest"), F.lit(threshold).alias("threshold"),
                         (F.col("drift_score") >= threshold).alias("drift_detected"))
