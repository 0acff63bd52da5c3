from collections import Counter

import pandas as pd

from vigil.operators import ordered, sample


def test_quota_sample_30_30(spark):
    rows = [(f"zero-{i}", 0.0) for i in range(30)] + [(f"one-{i}", 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, "Password string, Times double")
    a = sample.stratified_sample(df, "Password", "Times", size=20).collect()
    assert Counter(r.Times for r in a) == {0.0: 10, 1.0: 10}
    b = sample.stratified_sample(df.repartition(7), "Password", "Times", size=20).collect()
    assert sorted(a) == sorted(b)  # repeatable under repartitioning


def test_quota_topup_and_clamp(spark):
    rows = [(f"a{i}", 0.0) for i in range(3)] + [(f"b{i}", 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "Password string, Times double")
    got = sample.stratified_sample(df, "Password", "Times", size=5).collect()  # clamped up to 20
    assert len(got) == 20 and Counter(r.Times for r in got)[0.0] == 3


def test_quotas(spark):
    def quotas(counts, size):
        df = spark.createDataFrame([(f"{s}-{i}", s) for s, n in counts for i in range(n)], "k string, s long")
        return {r.s: r.quota for r in sample.stratum_quotas(df, "s", size).collect()}
    assert quotas([(0, 3), (1, 100)], 20) == {0: 3, 1: 17}
    assert quotas([(i, 5) for i in range(30)], 20) == {i: 1 for i in range(20)}
    assert quotas([(0, 50), (1, 1), (2, 2)], 20) == {0: 6, 1: 1, 2: 2}


def test_numeric_strata_and_order(spark):
    rows = [(f"k{i}", x) for i, x in enumerate(["1", "0", "NaN", "-1", "x", None, "0.0", "2"])]
    got = sample.stratified_sample(spark.createDataFrame(rows, "k string, s string"), "k", "s", numeric=True, ordered=True).collect()
    assert [(r.k, r.s) for r in got] == [("k1", 0.0), ("k6", 0.0), ("k0", 1.0), ("k7", 2.0)]
    assert sample.stratified_sample(spark.createDataFrame([], "k string, s string"), "k", "s").count() == 0


def test_half_split_overlap(spark):
    df = spark.createDataFrame([(i,) for i in range(11)], "k long")
    out = sample.half_split(df, "k").collect()
    train = sorted(r.k for r in out if r.half == "train")
    test = sorted(r.k for r in out if r.half == "test")
    assert train == list(range(0, 6)) and test == list(range(5, 11))
    out2 = sample.half_split(df, "k", overlap=False).collect()
    assert sorted(r.k for r in out2 if r.half == "train") == list(range(5))


def test_running_totals_match_pandas(spark):
    import random
    rnd = random.Random(3)
    rows = [(g, float(v), rnd.randint(0, 5)) for g in ("x", "y") for v in rnd.sample(range(10000), 500)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    got = ordered.running_totals(df, "v", ["w"], by="g", n_buckets=7).toPandas()
    exp = pd.DataFrame(rows, columns=["g", "v", "w"]).sort_values(["g", "v"])
    exp["cum_w"] = exp.groupby("g")["w"].cumsum()
    exp["next_v"] = exp.groupby("g")["v"].shift(-1)
    m = exp.merge(got, on=["g", "v"], suffixes=("", "_got"))
    assert len(m) == len(rows)
    assert (m["cum_w"] == m["cum_w_got"]).all()
    assert ((m["next_v"] == m["next_v_got"]) | (m["next_v"].isna() & m["next_v_got"].isna())).all()


def test_hash_sample_deterministic(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(200)], "k long, x double")
    a = sample.hash_sample(df, "k", 10).collect()
    b = sample.hash_sample(df.repartition(5), "k", 10).collect()
    assert a == b and len(a) == 10
