import math

from pyspark.sql import functions as F

from vigil.operators import metrics
from vigil.operators import model as M
from vigil.sources.thresholds import DEFAULT_THRESHOLDS


def scored(spark, times, preds):
    df = spark.createDataFrame([(p, float(t), float(v)) for p, t, v in zip("abcd", times, preds)],
                               "Password string, Times double, prediction double")
    return df.withColumn(M.LABEL, F.log10(F.col("Times") + 1))


def gate(spark, times, preds):
    s = scored(spark, times, preds)
    return M.quality_gate(M.quality_metrics(s, "Times"), DEFAULT_THRESHOLDS).orderBy("check_index").collect()


def test_perfect(spark):
    times = [0, 1, 0, 1]
    rows = gate(spark, times, [math.log10(t + 1) for t in times])
    assert all(r.passed for r in rows) and rows[0].value == 0.0


def test_reversed(spark):
    times = [0, 1, 0, 1]
    preds = [math.log10(t + 1) for t in times][::-1]
    rows = {r.metric: r for r in gate(spark, times, preds)}
    assert rows["rmse"].value > 0.23 and not rows["rmse"].passed
    assert rows["mae"].value > 0.18 and not rows["mae"].passed
    assert rows["rmse"].error.startswith("Model quality metric rmse=")


def test_log_scale(spark):
    s = scored(spark, [1.0], [math.log10(2)])
    m = M.quality_metrics(s, "Times").collect()[0]
    assert abs(m.rmse) < 1e-12


def test_non_finite_predictions(spark):
    rows = gate(spark, [0, 1, 0, 1], [0.0, float("nan"), 0.0, 0.3])
    assert all(not r.passed for r in rows) and rows[0].error == "Predictions contain non-finite values"


def test_regression_metrics_by_day(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2020, 9, 1, 5), 10.0, 11.0), (dt.datetime(2020, 9, 1, 7), 20.0, 18.0),
                                (dt.datetime(2020, 9, 2, 1), 5.0, 5.0)], "ts timestamp, y double, p double")
    out = {r.data_date.isoformat(): r for r in metrics.daily_regression_quality(df, "ts", "y", "p").collect()}
    a = out["2020-09-01"]
    assert a.n_rows == 2 and abs(a.mae - 1.5) < 1e-12 and abs(a.rmse - math.sqrt(2.5)) < 1e-12
    assert abs(a.mape - 100 * (0.1 + 0.1) / 2) < 1e-9 and a.report_date.isoformat() == "2020-09-02"
