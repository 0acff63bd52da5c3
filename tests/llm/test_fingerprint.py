import hashlib
import re

import pyspark.sql.functions as F

from tests.llm.conftest import SMALL
from vigil.llm import fingerprint, queries


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def tree(text):
    root, out = "", []
    for section in text.split("\n\n"):
        paras, shown = "", []
        for line in section.split("\n"):
            ds = [sha(p) for p in (re.findall(fingerprint.PIECES.replace("\\s", "[ \t\n\x0b\f\r]"), line) if line else [""])]
            paras += sha("".join(ds))
            shown.append(".".join(d[:8] for d in ds))
        root += sha(paras)
        out.append(",".join(shown))
    return sha(root) + ":" + ";".join(out)


def like(a, b):
    x, y = (set(re.split("[.,;]", p.rpartition(":")[2])) for p in (a, b))
    return 1.0 if a == b else len(x & y) / max(len(x), len(y))


def check(rows, docs):
    order = sorted(docs)
    want = []
    for n, (i, t) in enumerate(order):
        nxt = order[(n + 1) % len(order)][1]
        k = len(t) // 4
        e = t[:len(t) - k] + nxt[:k]
        want.append((i, len(t), sha(e), tree(t), tree(e), round(like(tree(t), tree(e)), 9), round(like(tree(t), tree(nxt)), 9)))
    got = sorted((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in rows)
    assert got == want


def test_query_equals_brute_force(spark, small_rows):
    check(queries.QUERIES["op3_fingerprints"](spark, SMALL).collect(), [(r[0], r[1] or "") for r in small_rows])


def test_odd_texts(spark, tmp_path):
    docs = [(5, ""), (7, "a\n\n\nb. c! d"), (9, "日本é" * 100), (11, "..!?  \n \n\t\nx"), (12, "a" * 500), (20, "end")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    check(queries.QUERIES["op3_fingerprints"](spark, str(tmp_path)).collect(), docs)
    one = f"{tmp_path}/one"
    spark.createDataFrame(docs[1:2], "doc_id long, text string").write.parquet(f"{one}/documents.parquet")
    check(queries.QUERIES["op3_fingerprints"](spark, one).collect(), docs[1:2])


def test_blank_lines_count(spark):
    texts = ["a\n\nb", "a\n \t\nb", "a\n\n\nb", "a\n\n \nb", "a\nb", "a\n\nb "]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(fingerprint.fingerprint(F.col("t")).alias("p"))
    assert len({r["p"].partition(":")[0] for r in df.collect()}) == len(texts)


def test_branches_that_differ(spark):
    a, b = "x. y\nz\n\nq\nr", "x. y\nZ\n\nq\nr\nnew"
    df = spark.createDataFrame([(a, b), (a, a)], "a string, b string").select(fingerprint.fingerprint(F.col("a")).alias("a"), fingerprint.fingerprint(F.col("b")).alias("b"))
    got = [[tuple(x) for x in r["d"]] for r in df.select(fingerprint.differing(F.col("a"), F.col("b")).alias("d")).collect()]
    assert got == [[(0, 1), (1, 2)], []]


def test_repeated_rows_nulls_and_empty_table(edge, empty, edge_rows):
    rows = fingerprint.with_next(edge).collect()
    assert len(rows) == len(edge_rows)
    prints = {}
    for r in rows:
        assert prints.setdefault(r["text"], r["fingerprint"]) == r["fingerprint"]
    assert {r["doc_id"] for r in rows} == {r[0] for r in edge_rows}
    assert fingerprint.with_next(empty).count() == 0
