"""Line numbers of landed files across splits, rejected lines, and event-time windows with late rows."""

import datetime as dt
import os

from pyspark.sql import functions as F

from vigil.sources.csv import numbered_lines, rejected_lines
from vigil.streaming.jobs import run_available
from vigil.streaming.latest import latest_per_key


def test_line_numbers_across_splits(spark, tmp_path):
    lines = {f"f{k}.csv": [f"{k},{i},{'x' * (i % 50)}" for i in range(500 + 137 * k)] for k in range(3)}
    for name, rows in lines.items():
        (tmp_path / name).write_text("\n".join(rows) + ("\n" if name != "f1.csv" else ""))
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    found = {(os.path.basename(r["file"]), r["line"]): r["value"] for r in got}
    assert len(found) == len(got) and found == {(n, i): v for n, rows in lines.items() for i, v in enumerate(rows, 1)}


def test_rejected_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h1,h2\n1,2\n,\n1,2,3\n1\nNA, \n"a,b",c\n"a,b",c,\n"x,y","z"\n1,2,\n')
    got = {(r["line"], r["reason"]) for r in rejected_lines(spark, str(tmp_path), 2).collect()}
    assert (3, "fully empty row") in got and (4, "too many fields") in got and (10, "too many fields") in got
    assert not {2, 5, 7, 9} & {line for line, _ in got}


def test_latest_per_key_with_late_rows(spark, tmp_path):
    """Rows behind the watermark change nothing; rows behind others but within it do."""
    schema = "ts timestamp, k string, v int"
    day = lambda d, h: dt.datetime(2024, 1, d, h)
    batches = [[(day(1, 1), "a", 1), (day(1, 5), "a", 2), (day(1, 2), "b", 3)], [(day(4, 0), "z", 0)], [(day(1, 23), "a", 99), (day(4, 1), "z", 1)], [(day(9, 0), "z", 5)]]
    out = f"{tmp_path}/out"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run_available(latest_per_key(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "k", "ts", ["v"]), f"late-{tmp_path.name}", out)
    rows = {(r["window_start"].day, r["k"]): r["v"] for r in spark.read.parquet(out).collect()}
    assert rows[1, "a"] == 2 and rows[1, "b"] == 3 and rows[4, "z"] == 1 and (9, "z") not in rows
    whole = spark.createDataFrame([r for b in batches for r in b if r[2] != 99], schema)
    batch = {(r["window_start"].day, r["k"]): r["v"] for r in latest_per_key(whole, "k", "ts", ["v"]).collect()}
    assert all(batch[k] == v for k, v in rows.items())
