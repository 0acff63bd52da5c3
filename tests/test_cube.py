"""The count cube: equal to drift and suite over the table itself, and extended by days alone."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vigil.operators import drift, suite
from vigil.operators.cube import Cube


def some_rows(days, n=60, seed=1):
    rng = random.Random(seed)
    return [(dt.datetime(2020, 1, d, rng.randrange(24)), float(rng.randrange(1, 50)), float(rng.randrange(1, 50)), float(rng.randrange(9)) if rng.random() > 0.1 else None, rng.choice(["a", "b", None]))
            for d in days for _ in range(n)] + [(None, 3.0, 4.0, 5.0, "a")]


SCHEMA = "ts timestamp, y double, p double, x double, c string"


def is_ref():
    return ~F.coalesce(F.col("ts") >= F.lit("2020-01-10").cast("timestamp"), F.lit(False))


def new_cube(spark, path, df):
    return Cube(spark, path, df.schema, "ts", "y", "p", ["y", "p", "x"], ["c"])


def rounded(rows):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(some_rows([1, 2, 3, 11, 12, 13]), SCHEMA)


def test_equal_to_the_table_itself(spark, table, tmp_path):
    cube = new_cube(spark, f"{tmp_path}/a", table)
    cube.add(table, is_ref())
    ref, cur = table.filter(is_ref()), table.filter(~is_ref())
    cols = ["column_name", "drift_score", "drift_detected"]
    assert rounded(cube.overall_drift().select(cols).collect()) == rounded(drift.drift_table(ref, cur, ["y", "p", "x"], ["c"]).select(cols).collect())
    days = ["data_date", *cols]
    want = drift.numeric_drift_by_day(ref, cur, ["y", "p", "x"], "ts").select(days).unionByName(drift.categorical_drift_by_day(ref, cur, ["c"], "ts").select(days))
    assert rounded(cube.daily_drift().select(days).collect()) == rounded(want.collect())
    whole = suite.daily_suite(ref, cur, "ts", "y", "p", ["c"], ["y", "p", "x"])
    assert rounded(suite.suite_of_cube(cube).collect()) == rounded(whole.select(suite.suite_of_cube(cube).columns).collect())


def test_a_new_day_is_scored_alone(spark, table, tmp_path):
    one = new_cube(spark, f"{tmp_path}/one", table)
    one.add(table, is_ref())
    grown = new_cube(spark, f"{tmp_path}/grown", table)
    last = F.coalesce(F.to_date("ts") == F.lit("2020-01-13").cast("date"), F.lit(False))
    half = F.col("y") > 25
    grown.add(table.filter(~last), is_ref())
    grown.daily_drift().count()
    scored = []
    inner = Cube._score
    grown._score = lambda new, version, place: (scored.append(grown._read("facts", new).select("data_date").distinct().count()), inner(grown, new, version, place))
    grown.add(table.filter(last & half), is_ref())
    grown.daily_drift().count()
    grown.add(table.filter(last & ~half), is_ref())  # the rest of the same day
    assert rounded(grown.daily_drift().select("data_date", "column_name", "drift_score").collect()) == rounded(one.daily_drift().select("data_date", "column_name", "drift_score").collect())
    assert scored == [1, 1]
    assert rounded(suite.suite_of_cube(grown).collect()) == rounded(suite.suite_of_cube(one).collect())


def test_new_reference_rows_change_every_day(spark, table, tmp_path):
    cube = new_cube(spark, f"{tmp_path}/r", table)
    late = F.coalesce(F.to_date("ts") == F.lit("2020-01-03").cast("date"), F.lit(False))
    cube.add(table.filter(~late), is_ref())
    cube.daily_drift().count()
    cube.add(table.filter(late), is_ref())
    whole = new_cube(spark, f"{tmp_path}/w", table)
    whole.add(table, is_ref())
    assert rounded(cube.daily_drift().select("data_date", "column_name", "drift_score").collect()) == rounded(whole.daily_drift().select("data_date", "column_name", "drift_score").collect())


def test_a_kind_of_columns_is_scored_alone(spark, table, tmp_path, monkeypatch):
    cube = new_cube(spark, f"{tmp_path}/e", table)
    cube.add(table, is_ref())
    monkeypatch.setattr(drift, "numeric_drift_by_day_of_counts", lambda *a: pytest.fail("numbers were scored"))
    days = ["data_date", "column_name", "drift_score", "stattest"]
    want = drift.categorical_drift_by_day(table.filter(is_ref()), table.filter(~is_ref()), ["c"], "ts")
    for _ in range(2):
        assert rounded(cube.daily_drift(numeric=False).select(days).collect()) == rounded(want.select(days).collect())
    assert len(list(tmp_path.glob("e/drift-*/scores/*"))) == 1  # once


def test_digests_are_exact_sums_of_the_hashes(spark):
    from vigil.operators.digest import column_digests, column_hashes
    rows = spark.range(2000).select(F.col("id").alias("a"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("b"))
    h = column_hashes(rows, ["a", "b"])
    got = h.agg(*column_digests(2))
    assert "decimal(28,0)" not in got._jdf.queryExecution().executedPlan().toString()  # no decimal a cell
    cells = h.select(F.xxhash64("_row", F.coalesce("_h0", F.lit(0)), F.col("_h0").isNull()).alias("x"), F.xxhash64("_row", F.coalesce("_h1", F.lit(0)), F.col("_h1").isNull()).alias("y")).collect()
    r = got.first()
    assert (int(r.digest0), int(r.digest1)) == (sum(c.x for c in cells), sum(c.y for c in cells)) and (r.values0, r.values1) == (2000, 1333)


def test_large_tables_of_the_cube_are_written_as_zstd(spark, table, tmp_path):
    import pyarrow.parquet as pq
    cube = new_cube(spark, f"{tmp_path}/g", table)
    cube.add(table, is_ref())
    files = list(tmp_path.glob("g/counts/*/*.parquet"))
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
