import datetime as dt

from vigil.operators import model as M
from vigil.streaming import daily_error_counts, run_available, scoring_stream


def test_scoring_stream_matches_batch(spark, tmpdir_path):
    rows = [(i, w, float(i % 2)) for i, w in enumerate(["abc", "qwerty", "hello", "zzz", "pass", "word"])]
    df = spark.createDataFrame(rows, "k long, Password string, Times double")
    model = M.fit_text_regressor(df, "Password", "Times", forest={"numTrees": 3})
    src = f"{tmpdir_path}/in"
    df.select("k", "Password").write.parquet(src)
    out = f"{tmpdir_path}/out"
    run_available(scoring_stream(spark, model, src, df.select("k", "Password").schema, "k"), "score", out)
    got = {r.k: r.prediction for r in spark.read.parquet(out).collect()}
    exp = {r.k: r.prediction for r in M.score(model, df, keep=["k"]).collect()}
    assert got == exp


def test_daily_error_window_with_watermark(spark, tmpdir_path):
    d = dt.datetime
    rows = [(d(2024, 1, 1, 1), "error"), (d(2024, 1, 1, 5), "view"), (d(2024, 1, 2, 3), "error"),
            (d(2024, 1, 5, 0), "view")]
    src = f"{tmpdir_path}/ev"
    spark.createDataFrame(rows, "ts timestamp, event_type string").write.parquet(src)
    stream = spark.readStream.schema("ts timestamp, event_type string").parquet(src)
    out = f"{tmpdir_path}/daily"
    from pyspark.sql import functions as F
    run_available(daily_error_counts(stream, "ts", F.col("event_type") == "error"), "daily", out)
    got = {r.window_start.date().isoformat(): (r.n_observations, r.n_errors) for r in spark.read.parquet(out).collect()}
    # windows closed by the watermark (max ts 2024-01-05 minus 1 day) are emitted
    assert got["2024-01-01"] == (2, 1) and got["2024-01-02"] == (1, 1)
