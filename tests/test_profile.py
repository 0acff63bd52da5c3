"""Exact quartiles, most frequent values, column digests and profiles against plain Python."""

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators import orderstats, profile


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_quantiles_of_awkward_columns(spark, buckets):
    rng = np.random.default_rng(2)
    hot = [7.0] * 400 + rng.normal(0, 5, 201).tolist()
    rows = [(float(v), float(i % 3), None, float("nan") if i % 5 == 0 else float(i)) for i, v in enumerate(hot)]
    df = spark.createDataFrame(rows, "hot double, few double, none double, nan double").repartition(4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r["column_name"], r["prob"]): r["value"] for r in orderstats.quantiles(df, df.columns, probs, buckets).collect()}
    assert len(got) == 4 * len(probs)
    for i, c in enumerate(df.columns):
        values = [r[i] for r in rows if r[i] is not None and r[i] == r[i]]
        for p in probs:
            want = np.quantile(values, p) if values else None
            assert got[c, p] == want if want is None else abs(got[c, p] - want) < 1e-9, (c, p)


def test_top_and_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", None), ("b", 2), (None, None)], "s string, n int")
    got = {r["column_name"]: tuple(r)[1:] for r in orderstats.most_frequent(orderstats.value_counts(df, ["s", "n"])).collect()}
    assert got == {"s": (2, "a", 2), "n": (2, "2", 2)}


def test_describe_and_profile(spark):
    rows = [(float(i % 7), "x" if i % 3 else "y", dt.date(2020, 1, 1 + i % 5), None) for i in range(50)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "v double, s string, d date, empty string")
    got = {(r["column_name"], r["stat"]): (r["value"], r["text"]) for r in profile.describe(df, ["v"], ["s", "empty"]).collect()}
    values = [r[0] for r in rows if r[0] is not None]
    assert got["v", "50%"][0] == statistics.median(values) and got["v", "count"][0] == 50 and abs(got["v", "std"][0] - statistics.stdev(values)) < 1e-12
    assert got["s", "top"] == (None, "x") and got["s", "freq"][0] == sum(r[1] == "x" for r in rows)
    assert got["empty", "count"][0] == 0 and got["empty", "unique"][0] == 0 and got["empty", "top"] == (None, None)
    full = {(r["column_name"], r["stat"]): (r["value"], r["text"]) for r in profile.column_profile(df).collect()}
    assert full["d", "first"][1] == "2020-01-01" and full["d", "most_common"][1] == "2020-01-01" and full["v", "missing"][0] == 1
    assert full["v", "most_common"][0] == 0.0 and abs(full["s", "missing_share"][0] - 1 / 51) < 1e-12
    none = {(r["column_name"], r["stat"]): r["value"] for r in profile.column_profile(df.limit(0)).collect()}
    assert none["v", "count"] == 0 and none["v", "25%"] is None and none["v", "missing_share"] is None


def test_duplicate_columns_by_digest(spark):
    """Swapped values, permuted columns, nulls, repeated rows: equal digests only for columns equal in every row."""
    rng = random.Random(3)
    base = [(rng.choice("ab"), rng.randrange(3)) for _ in range(40)]
    rows = [(s, n, s, n, "b" if s == "a" else "a", n if k else None, None, None) for k, (s, n) in enumerate(base)] * 2
    df = spark.createDataFrame(rows, "s string, n int, s2 string, n2 int, swapped string, almost int, gone string, gone2 int").repartition(3)
    got = {r["column_name"]: (r["duplicate_of"], r["is_constant"], r["is_empty"], r["n_missing"]) for r in profile.column_checks(df).collect()}
    assert {c: v[0] for c, v in got.items()} == {"s": None, "n": None, "s2": "s", "n2": "n", "swapped": None, "almost": None, "gone": None, "gone2": None}
    assert got["gone"][1:] == (True, True, 80) and got["almost"][3] == 2
    pair = spark.createDataFrame([("x", "y"), ("y", "x")], "a string, b string")
    assert [r["duplicate_of"] for r in profile.column_checks(pair).collect()] == [None, None]


def test_basic_tests_are_one_lazy_frame(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "a int, b string")
    rows = {r["test_name"]: (r["value"], r["status"]) for r in profile.basic_data_tests(df).collect()}
    assert rows["Share of Missing Values"] == (0.25, "FAIL") and rows["Number of Rows"] == (2.0, "SUCCESS")
    empty = {r["test_name"]: (r["value"], r["status"]) for r in profile.basic_data_tests(df.limit(0)).collect()}
    assert empty["Number of Rows"] == (0.0, "FAIL") and empty["Share of Missing Values"] == (None, "FAIL")
