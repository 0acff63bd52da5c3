import json

import pytest

from vigil.operators import profile, rules
from vigil.sources import csv as csvsrc
from vigil.sources.sinks import write_report_json

SCHEMA = "Password string, Times string"


def errors(spark, rows, schema=SCHEMA, **kw):
    df = spark.createDataFrame(rows, schema)
    return [r.error for r in rules.validation_errors(df, "Password", "Times", **kw).orderBy("error_index").collect()]


def test_valid_min(spark):
    assert errors(spark, [("abcd", "0.0"), ("efgh", "1.0")]) == []
    df = spark.createDataFrame([("abcd", "0.0"), ("efgh", "1.0")], SCHEMA)
    p = profile.raw_profile(df, "Password", "Times").collect()[0]
    assert (p.text_min_length, p.text_max_length, p.text_mean_length) == (4, 4, 4.0)
    assert p.positive_target_share == 0.5 and p.n_duplicate_rows == 0


def test_extra_column(spark):
    errs = errors(spark, [("abcd", "0.0", "x"), ("efgh", "1.0", "y")], "Password string, Times string, Garbage string",
                  required=["Password", "Times"])
    assert len(errs) == 1 and "exactly match" in errs[0] and "Garbage" in errs[0]


@pytest.mark.parametrize("values", [["0", "0.5", "1"], ["0", "2"], ["-1", "1"]])
def test_non_binary(spark, values):
    errs = errors(spark, [(f"a{'b' * i}", v) for i, v in enumerate(values)])
    assert any("{0.0, 1.0}" in e for e in errs)


@pytest.mark.parametrize("bad", ["ABC", "abc123", "abc def", "abc!", ""])
def test_bad_chars(spark, bad):
    errs = errors(spark, [(bad, "0"), ("valid", "1")])
    assert any(("lowercase letters" in e) or ("empty values" in e) for e in errs)


def test_share_bounds(spark):
    low = [(f"a{'a' * (i % 7)}", "0") for i in range(80)] + [(f"b{'b' * (i % 7)}", "1") for i in range(20)]
    errs = errors(spark, low)
    assert len(errs) == 1 and "positive share is 0.200" in errs[0]
    high = [(f"a{'a' * (i % 7)}", "0") for i in range(20)] + [(f"b{'b' * (i % 7)}", "1") for i in range(80)]
    assert "positive share is 0.800" in errors(spark, high)[0]


def test_not_a_number(spark):
    errs = errors(spark, [("valid", "not-a-number")])
    assert errs == ["Column Times contains non-numeric values"]
    df = spark.createDataFrame([("valid", "not-a-number")], SCHEMA)
    p = profile.raw_profile(df, "Password", "Times").collect()[0]
    assert p.n_rows == 1 and p.text_min_length == 5 and p.target_n_unique == 0


def test_suffix_numbers_are_not_numeric(spark):
    # '1d' / '1f' cast to 1.0 in Spark but are not numbers to a CSV reader
    assert "Column Times contains non-numeric values" in errors(spark, [("abc", "1d"), ("abd", "0")])


def test_phase_a_stops(spark):
    errs = errors(spark, [(None, None), ("abc", "1")])
    assert errs == ["DataFrame contains fully empty rows: 1 rows"]


def test_empty_table(spark):
    assert errors(spark, [], SCHEMA) == ["DataFrame must contain at least one row",
                                         "DataFrame contains fully empty columns: Password, Times"]


def test_bad_csv_and_report(spark, tmpdir_path):
    path = f"{tmpdir_path}/bad.csv"
    with open(path, "w") as f:
        f.write("Password,Times,Notes\n,1.0,\n ,0.0,\nabc,2.0,\n")
    read = csvsrc.read_raw_csv(spark, path)
    assert read.error is None and read.header == ["Password", "Times", "Notes"]
    df = read.df
    p = profile.raw_profile(df, "Password", "Times").collect()[0]
    assert p.n_rows == 3 and p.n_empty_columns == 1
    assert (p.text_min_length, p.text_max_length) == (1, 3)
    vals = sorted(r.value for r in profile.distinct_values(df, "Times").collect())
    assert vals == [0.0, 1.0, 2.0] and abs(p.positive_target_share - 2 / 3) < 1e-12
    rep = rules.validation_report(df, "Password", "Times", required=["Password", "Times"])
    out = f"{tmpdir_path}/report"
    write_report_json(rep, out)
    row = spark.read.json(out).collect()[0]
    assert row.is_valid is False and row.n_rows == 3 and len(row.errors) >= 1


def test_missing_file(spark, tmpdir_path):
    read = csvsrc.read_raw_csv(spark, f"{tmpdir_path}/nope.csv")
    assert read.df is None and read.error.startswith("Failed to read CSV file:")


def test_ragged_csv_is_read_failure(spark, tmpdir_path):
    path = f"{tmpdir_path}/ragged.csv"
    with open(path, "w") as f:
        f.write("Password,Times\nabc,1,extra\n")
    assert csvsrc.read_raw_csv(spark, path).error.startswith("Failed to read CSV file:")


def test_missing_tokens_are_null(spark, tmpdir_path):
    path = f"{tmpdir_path}/tokens.csv"
    with open(path, "w") as f:
        f.write("Password,Times\nnull,1\nabc,NA\n")
    df = csvsrc.read_raw_csv(spark, path).df
    counts = {r.rule: r.n_violations for r in rules.rule_violation_counts(df, "Password", "Times").collect()}
    assert counts["text_missing"] == 1 and counts["target_missing"] == 1


def test_rule_counts_unicode_strip(spark):
    df = spark.createDataFrame([("　abc ", "1"), ("abc\n", "0")], SCHEMA)
    counts = {r.rule: r.n_violations for r in rules.rule_violation_counts(df, "Password", "Times").collect()}
    assert counts["text_pattern"] == 0 and counts["text_empty"] == 0


def test_report_json_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([("abcd", "0.0"), ("efgh", "1.0")], SCHEMA)
    out = f"{tmpdir_path}/ok"
    write_report_json(rules.validation_report(df, "Password", "Times"), out)
    import glob
    line = open(glob.glob(f"{out}/*.json")[0]).read().strip()
    assert json.loads(line)["is_valid"] is True
