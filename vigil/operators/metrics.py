"""Regression-quality metrics (RMSE, MAE, mean error, MAPE, mean gap) as aggregate expressions.

All metrics are algebraic (sums and counts), so Spark computes them with a
map-side partial aggregate and a tiny final merge; a hot group costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regression_metric_columns(target, prediction) -> list[Column]:
    y, p = _c(target), _c(prediction)
    e = p - y
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(e).alias("mean_error"),
        F.abs(F.avg(e)).alias("abs_mean_error"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        # percentage error is undefined for a zero target; those rows are left out
        (F.lit(100.0) * F.avg(F.when(y != 0, F.abs(e) / F.abs(y)))).alias("mape"),
        F.avg(p).alias("prediction_mean"),
        F.avg(y).alias("target_mean"),
        F.abs(F.avg(p) - F.avg(y)).alias("prediction_target_mean_gap"),
        F.max(F.abs(e)).alias("max_abs_error"),
    ]


def regression_quality(df: DataFrame, target: str, prediction: str, by=None) -> DataFrame:
    """One row of metrics, or one row per group of ``by``."""
    cols = regression_metric_columns(target, prediction)
    return df.groupBy(*by).agg(*cols) if by else df.agg(*cols)


def daily_regression_quality(df: DataFrame, ts: str, target: str, prediction: str) -> DataFrame:
    """Metrics per calendar day of ``ts``, one grouped job; report date = data date + 1 day."""
    out = (df.groupBy(F.to_date(F.col(ts)).alias("data_date"))
             .agg(*regression_metric_columns(target, prediction)))
    return out.withColumn("report_date", F.date_add("data_date", 1))


def hourly_regression_quality(df: DataFrame, ts: str, target: str, prediction: str) -> DataFrame:
    return (df.groupBy(F.to_date(F.col(ts)).alias("data_date"), F.hour(F.col(ts)).alias("hour"))
              .agg(*regression_metric_columns(target, prediction)))


def error_by_group(df: DataFrame, key, target: str, prediction: str, name: str = "group") -> DataFrame:
    """Mean absolute error per group (e.g. per string length)."""
    return (df.groupBy(_c(key).alias(name))
              .agg(F.count(F.lit(1)).alias("n_rows"),
                   F.avg(F.abs(_c(prediction) - _c(target))).alias("mean_abs_error")))


def max_abs_error_by(df: DataFrame, by: str, expected: str, got: str) -> DataFrame:
    """Worst absolute difference per group (e.g. per verification round)."""
    return (df.groupBy(by)
              .agg(F.count(F.lit(1)).alias("n_rows"),
                   F.max(F.abs(F.col(got) - F.col(expected))).alias("max_abs_error")))


def log_target(c, plus_one: bool = True) -> Column:
    """log10(x + 1) (or log10(x)) — the model's target scale."""
    return F.log10(_c(c) + F.lit(1.0)) if plus_one else F.log10(_c(c))


def from_log_target(c, plus_one: bool = True) -> Column:
    return F.pow(F.lit(10.0), _c(c)) - (F.lit(1.0) if plus_one else F.lit(0.0))
