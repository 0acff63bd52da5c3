import pytest
from pyspark.sql import functions as F

from vigil.operators import model as M
from vigil.sources.registry import ModelRegistry


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([("qwerty", 0.1), ("123456", 0.2), ("password", 0.3), ("abc123", 0.4)],
                                 "Password string, Times double")


@pytest.fixture(scope="module")
def fitted(small):
    return M.fit_text_regressor(small, "Password", "Times", forest={"numTrees": 5})


def test_train_predicts_every_row(fitted, small):
    out = M.score(fitted, small).collect()
    assert len(out) == 4 and all(r.prediction == r.prediction for r in out)


def test_train_metrics(fitted, small):
    m = M.train_metrics(fitted, small, "Times").collect()[0]
    assert m.n_rows == 4 and m.rmse_train >= 0


def test_linear_and_no_tfidf(small):
    lin = M.fit_text_regressor(small, "Password", "Times", model="ridge", tfidf=False)
    assert M.score(lin, small).count() == 4


def test_registry_roundtrip_and_alias(spark, fitted, small, tmpdir_path):
    reg = ModelRegistry(spark, f"{tmpdir_path}/registry")
    r1 = reg.register(fitted, "pw", metrics={"rmse": 0.1, "kind": "forest"},
                      params={"n_estimators": 5, "api_token": "s3cr3t"}, alias="prod")
    assert r1["model_version"] == 1 and r1["alias_verified"] is True
    r2 = reg.register(fitted, "pw", alias="prod")
    assert r2["model_version"] == 2 and reg.resolve("pw", alias="prod") == 2
    reg.set_alias("pw", "prod", 1)
    assert reg.resolve("pw", alias="prod") == 1 and reg.resolve("pw", version=2) == 2
    loaded, v = reg.load("pw", alias="prod")
    assert v == 1
    params = spark.read.parquet(f"{tmpdir_path}/registry/model_params").collect()
    assert {p.param for p in params} == {"n_estimators"}  # sensitive key dropped
    a = M.score(fitted, small, keep=["Password"])
    b = M.score(loaded, small, keep=["Password"])
    par = M.parity(a, b, "Password").collect()[0]
    assert par.max_abs_error == 0.0 and par.within_tolerance and par.n_missing == 0


def test_parity_detects_difference(spark):
    e = spark.createDataFrame([("alpha", 1.0), ("beta", 2.0)], "k string, prediction double")
    g = spark.createDataFrame([("alpha", 1.01), ("beta", 2.0)], "k string, prediction double")
    r = M.parity(e, g, "k", tolerance=0.05).collect()[0]
    assert abs(r.max_abs_error - 0.01) < 1e-12 and r.within_tolerance
    g2 = spark.createDataFrame([("alpha", 1.0), ("beta", 2.2)], "k string, prediction double")
    assert not M.parity(e, g2, "k", tolerance=0.1).collect()[0].within_tolerance
    g3 = g.filter(F.col("k") == "alpha")
    assert not M.parity(e, g3, "k").collect()[0].within_tolerance


def test_vocabulary_has_every_ngram(spark, small):
    m = M.fit_text_regressor(small, "Password", "Times", forest={"numTrees": 2})
    want = {t[i:i + n] for t in ("qwerty", "123456", "password", "abc123") for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    assert set(m.stages[1].vocabulary) == want


def test_refit_does_not_depend_on_partitions(spark):
    rows = [("".join(chr(97 + (i * k) % 26) for k in range(1, 9)), float(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "t string, y double")
    preds = [M.score(M.fit_text_regressor(df.repartition(n), "t", "y", forest={"numTrees": 4}), df).orderBy("t", "y").collect() for n in (2, 3)]
    assert preds[0] == preds[1]


def gate(spark, rows):
    scored = spark.createDataFrame(rows, "y double, target_log double, prediction double")
    limits = {"model_quality": {"max_rmse": 0.23, "max_mae": 0.18, "max_abs_mean_error": 0.09, "max_prediction_target_mean_gap": 0.1}}
    return M.quality_gate(M.quality_metrics(scored, "y"), limits).orderBy("check_index").collect()


def test_gate_fails_on_targets_predictions_and_no_rows(spark):
    assert all(r.passed and r.error is None for r in gate(spark, [(1.0, 0.3, 0.3), (1.0, 0.3, 0.31)]))
    for bad in (None, float("nan"), float("-inf")):
        got = gate(spark, [(1.0, 0.3, 0.3), (-1.0, bad, 0.3)])
        assert all(r.passed is False and r.error == "Target log values contain non-finite values" for r in got)
    assert all(r.error == "Predictions contain non-finite values" for r in gate(spark, [(1.0, 0.3, None)]))
    assert all(r.passed is False for r in gate(spark, []))
    assert gate(spark, [(1.0, 0.3, 0.9)])[0].error == "Model quality metric rmse=0.600000 exceeds threshold max_rmse=0.230000"


def test_registry_never_overwrites(spark, fitted, tmpdir_path):
    a, b = ModelRegistry(spark, f"{tmpdir_path}/reg"), ModelRegistry(spark, f"{tmpdir_path}/reg")
    first = a.register(fitted, "pw", metrics={"rmse": 0.1, "n_rows": 4, "api_key": 1.0})
    b.versions = lambda: None  # a writer that has not seen the first version yet
    assert b.register(fitted, "pw")["model_version"] == first["model_version"] + 1
    metrics = {r.metric for r in spark.read.parquet(f"{tmpdir_path}/reg/model_metrics").collect()}
    assert metrics == {"rmse"} and spark.read.parquet(f"{tmpdir_path}/reg/model_params").first().param == "n_rows"
    with open(f"{tmpdir_path}/broken", "w") as f:
        f.write("no table")
    broken = ModelRegistry(spark, tmpdir_path)
    with pytest.raises(Exception):
        broken._read("broken").count()


def test_vocabulary_and_idf_cover_all_rows(spark):
    """With a bounded fit the vectors still come from the whole corpus: n-grams that only other rows have count in idf and length."""
    import math

    rows = [(f"ab{'xyz'[i % 3]}{chr(97 + i)}", float(i % 2)) for i in range(20)]
    df = spark.createDataFrame(rows, "t string, y double")
    model = M.fit_text_regressor(df, "t", "y", n_max=2, max_rows=4, model="ridge")
    vocabulary, idf, n_fit = M.corpus_vocabulary(df, M.fit_rows(df, "t", "y", 4), "t", 1, 2)
    grams = {t: {t[i:i + n] for n in (1, 2) for i in range(len(t) - n + 1)} for t, _ in rows}
    assert set(vocabulary) == set().union(*grams.values()) and 0 < n_fit < len(vocabulary)
    for g, v in zip(vocabulary, idf):
        assert abs(v - math.log(21 / (1 + sum(g in x for x in grams.values()))) - 1) < 1e-12
    out = model.transform(df).select("t", "_tfidf", "_fit").collect()
    weight = dict(zip(vocabulary, idf))
    for r in out:
        raw = {g: weight[g] * sum(r["t"].startswith(g, i) for i in range(len(r["t"]))) for g in grams[r["t"]]}
        size = math.sqrt(sum(w * w for w in raw.values()))
        assert all(abs(r["_tfidf"][vocabulary.index(g)] - w / size) < 1e-12 for g, w in raw.items())
        assert r["_fit"].size == n_fit


def test_alias_moves_of_two_writers(spark, tmpdir_path):
    """Many writers move one alias at once: every move has its own place in the log, and a compare-and-set wins once."""
    from concurrent.futures import ThreadPoolExecutor

    root = f"{tmpdir_path}/writers"
    one, two = ModelRegistry(spark, root), ModelRegistry(spark, root)
    with ThreadPoolExecutor(4) as pool:
        assert all(pool.map(lambda i: (one, two)[i % 2].set_alias("m", "prod", i), range(1, 9)))
    log = one._read("model_aliases").collect()
    assert sorted(r["seq"] for r in log) == list(range(1, 9)) and {r["version"] for r in log} == set(range(1, 9))
    now = one.resolve("m", alias="prod")
    assert now == max(log, key=lambda r: r["seq"])["version"]
    with ThreadPoolExecutor(4) as pool:
        won = list(pool.map(lambda i: (one, two)[i % 2].set_alias("m", "prod", 100 + i, expected=now), range(4)))
    assert sum(won) == 1 and two.resolve("m", alias="prod") == 100 + won.index(True)
    assert one.set_alias("m", "new", 5, expected=0) and not one.set_alias("m", "new", 6, expected=0)


def test_a_lost_writer_is_passed_over(spark, tmpdir_path):
    reg = ModelRegistry(spark, f"{tmpdir_path}/lost")
    assert reg._claim("m", "aliases", "prod", "s1")  # and never appended
    assert reg.set_alias("m", "prod", 3, wait=0.2) and reg.resolve("m", alias="prod") == 3


def test_gate_deals_the_test_half_after_its_join(spark, tmpdir_path, monkeypatch):
    """The texts of the test half lie together in one file: they are still scored in several tasks."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    from vigil.plans import model_queries as Q
    spark.createDataFrame([(i, f"text {i}") for i in range(400)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int").coalesce(1).write.parquet(f"{tmpdir_path}/labels.parquet")
    seen = []
    monkeypatch.setattr(Q, "fitted", lambda *a: PipelineModel([SQLTransformer(statement="SELECT *, 0.1D AS prediction FROM __THIS__")]))
    kept = M.scored_table
    monkeypatch.setattr(M, "scored_table", lambda model, df, target: seen.append(kept(model, df, target)) or seen[-1])
    assert len(Q.train_and_gate(spark, tmpdir_path).collect()) == 4
    sizes = seen[0].groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == 4 and sum(r["count"] for r in sizes) == 200


@pytest.fixture(scope="module")
def by_hash(spark):
    """1,000 texts of one kind, and 100 of another whose hashes are all larger."""
    texts = spark.createDataFrame([(f"{kind}{i}",) for kind in ("ab", "zq") for i in range(2200)], "t string")
    hashed = [(r["t"], r["h"]) for r in texts.select("t", F.xxhash64("t").alias("h")).orderBy("h").collect()]
    low = [x for x in hashed if x[0].startswith("ab")][:1000]
    high = [x for x in hashed if x[0].startswith("zq") and x[1] > low[-1][1]][:100]
    assert len(high) == 100
    return [t for t, _ in low], [t for t, _ in high]


def test_fit_takes_every_labelled_row(spark, by_hash):
    """1,100 rows: what only the 100 with the largest hashes of their text hold is learned too."""
    low, high = by_hash
    df = spark.createDataFrame([(t, 0.0) for t in low] + [(t, 99.0) for t in high], "t string, y double")
    model = M.fit_text_regressor(df, "t", "y", n_max=2, forest={"numTrees": 4, "maxDepth": 2})
    got = M.score(model, df).groupBy("y").agg(F.min("prediction").alias("lo"), F.max("prediction").alias("hi")).collect()
    assert {r["y"]: (round(r["lo"], 9), round(r["hi"], 9)) for r in got} == {0.0: (0.0, 0.0), 99.0: (2.0, 2.0)}


def test_gate_sees_a_model_of_the_whole_train_half(spark, by_hash, tmpdir_path):
    """The test half is made of texts like the 100 of the 1,100 training rows that have the largest hashes: they are known, and the gate passes."""
    from vigil.plans import model_queries as Q
    low, high = by_hash
    rows = [(i, t, int(t in high)) for i, t in enumerate(low + high + high * 11)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    df.select("doc_id", "text").write.parquet(f"{tmpdir_path}/documents.parquet")
    df.select("doc_id", "quality").write.parquet(f"{tmpdir_path}/labels.parquet")
    got = Q.train_and_gate(spark, tmpdir_path).collect()
    assert len(got) == 4 and all(r["passed"] and abs(r["value"]) < 1e-6 for r in got)
    assert Q.fitted(spark, tmpdir_path).stages[-1].getNumTrees == 50
