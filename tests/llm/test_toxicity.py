import random

import numpy as np
from pyspark.sql import functions as F

from vigil.llm import queries, toxicity

DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = queries.QUERIES["op4_toxicity"](spark, DIR).cache()
    assert out.count() == spark.read.parquet(f"{DIR}/documents.parquet").count()
    joined = out.join(spark.read.parquet(f"{DIR}/labels.parquet"), "doc_id")
    # few labelled texts here: words of the other languages' insults are rarely met twice
    hits = joined.filter("held_out").agg(F.sum(F.expr("int(toxic = 1 and predicted = 1)")).alias("tp"), F.sum(F.expr("int(toxic = 0 and predicted = 1)")).alias("fp"), F.sum("toxic").alias("n"), F.count("*").alias("all")).first()
    assert hits["tp"] >= 0.5 * hits["n"] and hits["fp"] <= 0.02 * hits["all"]
    assert out.filter("score < 0 or score > 1 or predicted != int(score >= 0.7)").count() == 0


def rows(n=120):
    for i in range(n):
        draw = random.Random(i)
        plain = " ".join("w" + "".join(draw.choices("aeiou", k=3)) + "x" for _ in range(20))
        yield 2 * i, plain + ".", 0
        yield 2 * i + 1, plain + " you blorbish" + "abcdefg"[i % 7] + " fool. End", 1


def test_spans_are_offsets_of_toxic_words(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows()], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows()], "doc_id long, toxic int"))
    text = "Ünder waeix. Then blorbishq came"  # an ending that was not in training
    row = toxicity.score(spark.createDataFrame([(text,)], "text string"), model).first()
    assert row["predicted"] == 1 and any("blorbishq" in text[s["start"]:s["end"]] for s in row["spans"])
    again = toxicity.fit(docs.repartition(3), spark.createDataFrame([(i, y) for i, _, y in rows()], "doc_id long, toxic int"))
    assert again == model


def test_copies_count_once():
    texts, toxic = [], []
    for i, t, y in rows():
        texts.append(t)
        toxic.append(y)
    copies = texts + ["quite innocent zebra words here again. " * 2] * 80
    m = toxicity.fit_field(copies, np.array(toxic + [1] * 80))
    assert all("zebra" not in f or w <= 0.5 for f, w in m["weights"].items())


def test_edge_rows_and_empty_tables(spark, edge, empty, edge_rows):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 13)], "doc_id long, toxic int")
    model = toxicity.fit(edge, labels)
    out = toxicity.score(edge, model).collect()
    assert len(out) == len(edge_rows) and all(r["score"] == 0 and r["spans"] == [] for r in out if not (r["text"] or "").strip())
    assert toxicity.score(empty, model).count() == 0
    assert all(r["score"] < 0.01 for r in toxicity.score(edge, toxicity.fit(empty, labels)).collect())
