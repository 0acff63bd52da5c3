"""The distributed n-gram dictionary and ridge by normal equations, against plain numpy."""

import math
from collections import Counter

import numpy as np
import pytest

from vigil.operators import ridge
from vigil.operators import textfeatures as tx

ROWS = [(1, "abba", 1.0), (2, "cab  Cab", 0.0), (3, "", 2.0), (4, None, 1.0), (5, "zz top", 0.0), (6, "abba", 3.0), (7, "bcd", None), (8, "é日 a", 5.0)]


def grams(text, lo, hi):
    t = "" if text is None else " ".join(text.lower().split("  "))
    return Counter(t[i:i + n] for n in range(lo, hi + 1) for i in range(len(t) - n + 1))


def entropy(text):
    c = Counter(text or "")
    n = sum(c.values())
    return math.log2(n) - sum(k * math.log2(k) for k in c.values()) / n if n else 0.0


def plain(rows, lo, hi, reg, tfidf):
    fit = [r for r in rows if r[2] is not None]
    names = sorted({g for r in fit for g in grams(r[1], lo, hi)}, key=lambda g: g.encode())
    df = Counter(g for r in fit for g in grams(r[1], lo, hi))
    idf = {g: math.log((1 + len(fit)) / (1 + df[g])) + 1 for g in names}

    def vector(text):
        tf = grams(text, lo, hi)
        v = np.array([tf[g] * (idf[g] if tfidf else 1.0) for g in names])
        size = np.linalg.norm(v)
        return np.append(v / size if tfidf and size else v, entropy(text))

    x, y = np.array([vector(r[1]) for r in fit]), np.array([math.log10(r[2] + 1) for r in fit])
    mx, my = x.mean(0), y.mean()
    beta = np.linalg.solve((x - mx).T @ (x - mx) + reg * np.eye(x.shape[1]), (x - mx).T @ (y - my))
    return names, idf, {r[0]: my + (vector(r[1]) - mx) @ beta for r in rows}


@pytest.mark.parametrize("lo, hi, tfidf, reg", [(1, 1, True, 1.0), (1, 3, True, 0.5), (1, 2, False, 2.0)])
def test_against_numpy(spark, tmp_path, monkeypatch, lo, hi, tfidf, reg):
    monkeypatch.setattr(ridge, "BLOCK", 7)
    monkeypatch.setattr(ridge, "CHUNK_ROWS", 2)
    df = spark.createDataFrame(ROWS, "k long, text string, y double").repartition(3)
    names, idf, want = plain(ROWS, lo, hi, reg, tfidf)
    model = ridge.fit(df, "k", "text", "y", reg=reg, n_range=(lo, hi), tfidf=tfidf)
    table = {r["ngram"]: r for r in model.dictionary.collect()}
    assert [g for g, _ in sorted(table.items(), key=lambda x: x[1]["id"])] == names
    assert all(abs(table[g]["idf"] - idf[g]) < 1e-12 for g in names)
    got = {r["k"]: r["prediction"] for r in ridge.score(model, df, "k", "text").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    ridge.save(model, f"{tmp_path}/m")
    again = {r["k"]: r["prediction"] for r in ridge.score(ridge.load(spark, f"{tmp_path}/m"), df, "k", "text").collect()}
    assert again == got


def test_bounds_and_empty(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, "k long, text string, y double")
    monkeypatch.setattr(ridge, "MAX_FEATURES", 3)
    with pytest.raises(ValueError, match="at most 3"):
        ridge.fit(df, "k", "text", "y")
    with pytest.raises(ValueError, match="no rows"):
        ridge.fit(df.limit(0), "k", "text", "y")


def test_sparse_vectors(spark):
    df = spark.createDataFrame(ROWS, "k long, text string, y double")
    g = tx.document_grams(df, "k", "text", 1, 2)
    vectors = tx.sparse_vectors(tx.sparse_weights(g, tx.ngram_dictionary(df, "k", "text", 1, 2), "k"), "k").collect()
    assert {r["k"] for r in vectors} == {1, 2, 5, 6, 7, 8}
    for r in vectors:
        assert r["ids"] == sorted(set(r["ids"])) and abs(sum(w * w for w in r["weights"]) - 1) < 1e-12
