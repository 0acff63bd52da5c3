from vigil.operators import serving


def test_consistency_null_is_a_value(spark):
    obs = spark.createDataFrame([("/predict", "i1", "3"), ("/predict", "i1", None), ("/model_state", "i1", "3")],
                                "endpoint string, instance_id string, loaded_version string")
    rows = {r.endpoint: r for r in serving.consistency_check(obs, "endpoint", "instance_id", "loaded_version").collect()}
    assert rows["/predict"].n_versions == 2 and rows["/predict"].multiple_versions
    assert not rows["/model_state"].multiple_versions
    assert rows[None].n_observations == 3 and rows[None].n_instances == 1


def test_latest_by_key(spark):
    df = spark.createDataFrame([("u", 1, "a"), ("u", 3, "c"), ("u", 2, "b"), ("v", 1, "z")], "k string, t int, x string")
    got = {r.k: (r.x, r.n_rows) for r in serving.latest_by_key(df, "k", ["t"], ["x"]).collect()}
    assert got == {"u": ("c", 3), "v": ("z", 1)}


def test_state_warnings(spark):
    st = spark.createDataFrame([("i1", True, "success", "5"), ("i2", False, "failed", "4")],
                               "instance_id string, model_loaded boolean, last_reload_status string, loaded_version string")
    got = {r.instance_id: r.warnings for r in serving.state_warnings(st, expected_version="5").collect()}
    assert got["i1"] == [] and len(got["i2"]) == 3
    assert got["i2"][2].endswith("loaded unexpected model version: '4' != '5'.")


def test_worst_error_by_round(spark):
    df = spark.createDataFrame([(1, 1.0, 1.01), (1, 2.0, 2.0), (2, 1.0, 1.2)], "r int, e double, g double")
    got = {r.r: r.within_tolerance for r in serving.worst_error_by_round(df, "r", "e", "g").collect()}
    assert got == {1: True, 2: False}
