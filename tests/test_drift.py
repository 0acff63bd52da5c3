import math
from collections import Counter

import numpy as np

from vigil.operators import drift


def wasserstein(u, v):
    allv = np.sort(np.concatenate([u, v]))
    d = np.diff(allv)
    cu = np.searchsorted(np.sort(u), allv[:-1], "right") / len(u)
    cv = np.searchsorted(np.sort(v), allv[:-1], "right") / len(v)
    return float(np.sum(np.abs(cu - cv) * d))


def js(u, v):
    cu, cv = Counter(u), Counter(v)
    keys = set(cu) | set(cv)
    p = np.array([cu[k] / len(u) for k in keys])
    q = np.array([cv[k] / len(v) for k in keys])
    m = (p + q) / 2
    kl = lambda a: np.sum(np.where(a > 0, a * np.log(np.where(a > 0, a, 1) / m), 0))
    return math.sqrt((kl(p) + kl(q)) / 2)


def test_numeric_drift_vs_bruteforce(spark):
    rng = np.random.default_rng(1)
    ru, cu = rng.normal(0, 1, 400).round(2), rng.normal(0.3, 1.2, 300).round(2)
    ref = spark.createDataFrame([(float(x),) for x in ru], "x double")
    cur = spark.createDataFrame([(float(x),) for x in cu], "x double")
    got = drift.numeric_drift(ref, cur, ["x"], n_buckets=5).collect()[0]
    exp = wasserstein(ru, cu) / max(np.std(ru), 0.001)
    assert abs(got.drift_score - exp) < 1e-9 and got.drift_detected == (exp >= 0.1)


def test_categorical_drift_vs_bruteforce(spark):
    ru = list("aaabbbcccd" * 5)
    cu = list("aabbbbeeee" * 3)
    ref = spark.createDataFrame([(x,) for x in ru], "c string")
    cur = spark.createDataFrame([(x,) for x in cu], "c string")
    got = drift.categorical_drift(ref, cur, ["c"]).collect()[0]
    assert abs(got.drift_score - js(ru, cu)) < 1e-12


def test_daily_js_matches_whole(spark):
    import datetime as dt
    ru = list("aaabbbcccd")
    cu = list("aabbbbeeee")
    ref = spark.createDataFrame([(x, dt.datetime(2020, 1, 1)) for x in ru], "c string, ts timestamp")
    cur = spark.createDataFrame([(x, dt.datetime(2020, 2, 1, 3)) for x in cu], "c string, ts timestamp")
    day = drift.categorical_drift_by_day(ref, cur, ["c"], "ts").collect()[0]
    assert abs(day.drift_score - js(ru, cu)) < 1e-12


def test_drift_share(spark):
    t = spark.createDataFrame([("a", True), ("b", False), ("c", True), ("d", False)], "column_name string, drift_detected boolean")
    r = drift.drift_share(t).collect()[0]
    assert r.n_drifted_columns == 2 and r.share_of_drifted_columns == 0.5 and r.dataset_drift


def test_numeric_drift_by_day_vs_bruteforce(spark):
    import datetime as dt
    rng = np.random.default_rng(7)
    ref = [(None, float(x), float(y)) for x, y in zip(rng.integers(0, 20, 300), rng.normal(5, 2, 300).round(1))]
    ref += [(None, None, float("nan"))]
    days = {
        dt.date(2024, 1, 1): (rng.integers(5, 30, 40), rng.normal(6, 3, 40).round(1)),   # past both ends
        dt.date(2024, 1, 2): (np.array([7] * 5), np.array([5.0] * 5)),                     # one value
        dt.date(2024, 1, 3): (np.array([-3, 50]), np.array([100.0, -100.0])),               # outside the range
        dt.date(2024, 1, 4): (rng.integers(0, 20, 60), rng.normal(5, 2, 60).round(1)),     # like the reference
    }
    cur = []
    for d, (a, b) in days.items():
        ts = dt.datetime.combine(d, dt.time(12))
        cur += [(ts, float(x), float(y)) for x, y in zip(a, b)]
    cur += [(dt.datetime(2024, 1, 4, 1), None, None)]
    schema = "ts timestamp, a double, b double"
    out = drift.numeric_drift_by_day(spark.createDataFrame(ref, schema), spark.createDataFrame(cur, schema),
                                     ["a", "b"], "ts", n_buckets=4)
    got = {(r.data_date, r.column_name): r.drift_score for r in out.collect()}
    assert len(got) == 8
    for j, c in enumerate(["a", "b"]):
        rv = np.array([r[1 + j] for r in ref if r[1 + j] is not None and not math.isnan(r[1 + j])])
        sd = max(float(np.std(rv)), drift.STD_FLOOR)
        for d, cols in days.items():
            want = wasserstein(rv, np.asarray(cols[j], dtype=float)) / sd
            assert abs(got[(d, c)] - want) < 1e-9, (d, c, got[(d, c)], want)


def test_asof_last_vs_search(spark):
    from vigil.operators.ordered import asof_last
    rng = np.random.default_rng(3)
    knots = [("g1", float(k), f"k{k}") for k in sorted(set(rng.integers(0, 100, 30)))] + [("g2", 50.0, "only")]
    probes = [(g, float(x), i) for i, (g, x) in enumerate(
        [("g1", v) for v in rng.integers(-5, 110, 80)] + [("g2", 10), ("g2", 50), ("g2", 70), ("g3", 1)])]
    kdf = spark.createDataFrame(knots, "g string, x double, label string")
    pdf = spark.createDataFrame(probes, "g string, x double, pid int")
    got = {r.pid: r.label for r in asof_last(pdf, kdf, "g", "x", ["label"], n_buckets=5).collect()}
    assert len(got) == len(probes)
    for g, x, pid in probes:
        below = [k for k in knots if k[0] == g and k[1] <= x]
        assert got[pid] == (max(below, key=lambda k: k[1])[2] if below else None), (g, x)


def test_daily_suite_drift_share_counts_numeric_columns(spark):
    import datetime as dt
    from vigil.operators import suite
    schema = "ts timestamp, y double, p double, x double, c string"
    base = [(1.0, 1.0, 1.0, "a"), (2.0, 2.0, 2.0, "b"), (3.0, 3.0, 3.0, "a"), (4.0, 4.0, 4.0, "b")]
    ref = spark.createDataFrame([(dt.datetime(2023, 6, 1),) + r for r in base], schema)
    same = [(dt.datetime(2024, 1, 1, 9),) + r for r in base]
    shifted = [(dt.datetime(2024, 1, 2, 9), y, p, x + 10.0, c) for y, p, x, c in base]
    cur = spark.createDataFrame(same + shifted, schema)
    out = suite.daily_suite(ref, cur, "ts", "y", "p", ["c"], ["x"])
    rows = {(r.data_date.day, r.test_name): r for r in out.collect()}
    share = "Share of Drifted Columns"
    assert rows[(1, share)].value == 0.0 and rows[(1, share)].status == "SUCCESS"
    assert rows[(2, share)].value == 0.5 and rows[(2, share)].status == "FAIL"
    only_cat = {(r.data_date.day, r.test_name): r for r in suite.daily_suite(ref, cur, "ts", "y", "p", ["c"]).collect()}
    assert only_cat[(2, share)].value == 0.0


def test_a_side_without_values_has_no_score(spark):
    ref = spark.createDataFrame([(1.0, "a", None)] * 3, "x double, c string, n double")
    cur = spark.createDataFrame([(None, None, 2.0)] * 3, "x double, c string, n double")
    rows = drift.drift_table(ref, cur, ["x", "n"], ["c"]).collect()
    assert {r.column_name for r in rows} == {"x", "n", "c"} and all(r.drift_score is None and r.drift_detected is None for r in rows)
    share = drift.drift_share(drift.drift_table(ref, cur, ["x"], ["c"])).first()
    assert share.n_columns == 2 and share.n_drifted_columns == 0 and share.dataset_drift is False
    none = drift.drift_share(drift.drift_table(ref, cur, ["x"], ["c"]).limit(0)).first()
    assert none.share_of_drifted_columns is None and none.dataset_drift is False


def test_buckets_by_halving_are_the_numbers_of_bounds_below(spark):
    from vigil.operators.ordered import bucket_from_bounds
    bounds = {"a": [float(i) * 3 for i in range(1000)], "b": [5.0], "c": []}
    df = spark.createDataFrame([(g, v) for g in ("a", "b", "c", "d", None) for v in (None, -1.0, 0.0, 0.1, 2.0, 3.0, 5.0, 6.5, 1500.0, 2997.0, 2998.0, 1e9, float("nan"))], "g string, v double")
    out = df.withColumn("n", bucket_from_bounds("v", "g", bounds))
    assert "filter(" not in out._jdf.queryExecution().executedPlan().toString()  # no pass over all bounds a row
    for r in out.collect():
        assert r.n == sum(r.v is not None and (b < r.v or r.v != r.v) for b in bounds.get(r.g, []))
    for n in (0, 1, 2, 3, 64):
        one = [float(i) for i in range(n)]
        for r in df.withColumn("n", bucket_from_bounds("v", None, one)).collect():
            assert r.n == sum(r.v is not None and (b < r.v or r.v != r.v) for b in one)


def test_asof_carries_the_last_knot_over_empty_buckets(spark):
    from vigil.operators.ordered import asof_last
    knots = spark.createDataFrame([("a", 1.0, "x"), ("a", 2.0, "y"), ("a", 50.0, None), ("b", 7.0, "z")], "g string, k double, p string")
    probes = spark.createDataFrame([(g, k) for g in ("a", "b", "c") for k in (0.0, 1.0, 3.5, 40.0, 60.0)], "g string, k double")
    got = {(r.g, r.k): r.p for r in asof_last(probes, knots, "g", "k", ["p"], bounds={"a": [0.5, 2.0, 10.0, 20.0, 55.0], "b": [1.0, 30.0]}).collect()}
    assert got == {("a", 0.0): None, ("a", 1.0): "x", ("a", 3.5): "y", ("a", 40.0): "y", ("a", 60.0): None, ("b", 0.0): None, ("b", 1.0): None, ("b", 3.5): None, ("b", 40.0): "z", ("b", 60.0): "z", **{("c", k): None for k in (0.0, 1.0, 3.5, 40.0, 60.0)}}
