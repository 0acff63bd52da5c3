import datetime as dt
import os

from vigil.operators import metrics, profile, rules
from vigil.sources import csv as csvsrc
from vigil.sources.sinks import write_csv, write_table_log


def test_basic_data_tests(spark):
    df = spark.createDataFrame([("a", "a", None), ("b", "b", None)], "x string, y string, z string")
    got = {r.test_name: r.status for r in profile.basic_data_tests(df).collect()}
    assert got["Number of Rows"] == "SUCCESS"
    assert got["Share of Missing Values"] == "FAIL" and got["Number of Empty Columns"] == "FAIL"
    assert got["Number of Duplicated Columns"] == "FAIL" and got["Number of Empty Rows"] == "SUCCESS"


def test_request_guard(spark):
    df = spark.createDataFrame([("abc",), ("  ",), (None,)], "Password string")
    ok, bad = rules.request_guard(df, "Password")
    assert [r.Password for r in ok.collect()] == ["abc"] and bad.count() == 2


def test_landing_check_and_sinks(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/land")
    open(f"{tmpdir_path}/land/a.csv", "w").write("Password,Times\nabc,1\n")
    open(f"{tmpdir_path}/land/empty.csv", "w").close()
    full = csvsrc.landing_check(spark, f"{tmpdir_path}/land/*.csv").first()
    assert full.n_files >= 1 and full.passed and not full.is_empty
    open(f"{tmpdir_path}/land/none.txt", "w").close()
    none = csvsrc.landing_check(spark, f"{tmpdir_path}/land/*.txt").first()
    assert (none.n_files, none.is_empty, none.passed) == (0, True, False)
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    write_csv(df, f"{tmpdir_path}/out_csv")
    assert spark.read.option("header", True).csv(f"{tmpdir_path}/out_csv").count() == 1
    write_table_log(df, f"{tmpdir_path}/log")
    write_table_log(df, f"{tmpdir_path}/log")
    assert spark.read.parquet(f"{tmpdir_path}/log").count() == 2


def test_hourly_and_error_by_length(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 9, 1, 5, 10), "ab", 1.0, 2.0),
                                (dt.datetime(2020, 9, 1, 5, 50), "abc", 1.0, 1.5),
                                (dt.datetime(2020, 9, 1, 6, 0), "ab", 2.0, 2.0)],
                               "ts timestamp, p string, y double, yhat double")
    h = {(r.hour): r.n_rows for r in metrics.hourly_regression_quality(df, "ts", "y", "yhat").collect()}
    assert h == {5: 2, 6: 1}
    from pyspark.sql import functions as F
    e = {r.length: r.mean_abs_error for r in
         metrics.error_by_group(df, F.length("p"), "y", "yhat", name="length").collect()}
    assert e == {2: 0.5, 3: 0.5}


def _csv(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(text)
    return folder


def test_headers_of_all_files_are_compared(spark, tmpdir_path):
    good = csvsrc.read_raw_csv(spark, _csv(f"{tmpdir_path}/good", a="P,T\nx,1\n", b="P,T\ny,2\n"))
    assert good.error is None and sorted(tuple(r) for r in good.df.collect()) == [("x", "1"), ("y", "2")]
    assert csvsrc.read_raw_csv(spark, _csv(f"{tmpdir_path}/swap", a="P,T\nx,1\n", b="T,P\n2,y\n")).error
    assert csvsrc.read_raw_csv(spark, _csv(f"{tmpdir_path}/rep", a="P,P\nx,1\n", b="P,Q\n2,y\n")).error


def test_short_long_and_quoted_rows(spark, tmpdir_path):
    short = csvsrc.read_raw_csv(spark, _csv(f"{tmpdir_path}/short", a="P,T,U\nx\ny,1,2\n"))
    assert short.error is None and sorted(map(str, (tuple(r) for r in short.df.collect()))) == ["('x', None, None)", "('y', '1', '2')"]
    assert "number of fields" in csvsrc.read_raw_csv(spark, _csv(f"{tmpdir_path}/long", a="P,T\nx,1,2\n")).error
    quoted = csvsrc.read_raw_csv(spark, _csv(f"{tmpdir_path}/quoted", a='"a,b",c\n"1\n2",3\n'), multiline=True)
    assert quoted.header == ["a,b", "c"] and [tuple(r) for r in quoted.df.collect()] == [("1\n2", "3")]
