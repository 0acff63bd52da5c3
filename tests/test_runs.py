import random

from vigil.operators.runs import training_run


def write_csv(path, n_zero, n_one, seed=7):
    rnd = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    with open(path, "w") as f:
        f.write("Password,Times\n")
        for t, n in ((0, n_zero), (1, n_one)):
            for _ in range(n):
                f.write("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 10))) + f",{t}\n")


def test_good_run_registers_and_reports(spark, tmpdir_path):
    p = f"{tmpdir_path}/good.csv"
    write_csv(p, 100, 100)
    out = training_run(spark, p, f"{tmpdir_path}/reg", forest={"numTrees": 3, "maxDepth": 4})
    assert out["valid"] and out["registration"]["alias_verified"] is True
    rep = out["report"].collect()[0]
    assert rep.is_valid is True and rep.quality_valid in (True, False)
    assert rep.schema_metrics["n_rows"] == 200 and rep.quality_metrics["row_count"] == 200 and rep.quality_metrics["rmse"] >= 0
    assert {r.step for r in out["steps"].collect()} == {"read", "validate", "train", "register", "quality"}


def test_bad_share_stops_before_training(spark, tmpdir_path):
    p = f"{tmpdir_path}/bad.csv"
    write_csv(p, 160, 40)
    out = training_run(spark, p, f"{tmpdir_path}/reg2")
    assert not out["valid"] and out["registration"] is None
    assert out["errors"][0].startswith("Column Times has invalid target distribution: positive share is 0.200")


def test_missing_column_not_valid(spark, tmpdir_path):
    p = f"{tmpdir_path}/one.csv"
    with open(p, "w") as f:
        f.write("Password\npassword123\n")
    out = training_run(spark, p, f"{tmpdir_path}/reg3")
    assert not out["valid"] and out["registration"] is None
