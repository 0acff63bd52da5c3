import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SMALL
from vigil.llm import neardup, queries
from vigil.llm.components import components


def brute_classes(docs, idf):
    """Classes by comparing all pairs of distinct texts."""
    words, sets = neardup.Words(idf), {}
    for i, t in docs:
        h, w, _ = neardup.shingles(words, [t])
        sets[i] = dict(zip(h.tolist(), w.tolist()))
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids, text = sorted(sets), dict(docs)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            a, b = sets[i], sets[j]
            common = a.keys() & b.keys()
            if text[i] != text[j]:
                if not common:
                    continue
                both = sum(min(a[x], b[x]) for x in common)
                if both / (sum(a.values()) + sum(b.values()) - both) < neardup.THRESHOLD:
                    continue
            group[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in ids}


def test_query_equals_all_pairs(spark, small_rows):
    docs = spark.createDataFrame([(r[0], r[1]) for r in small_rows], "doc_id long, text string")
    want = brute_classes([(r[0], r[1]) for r in small_rows], neardup.word_idf(docs, "text"))
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_minhash_near_dedup"](spark, SMALL).collect()}
    assert {i: r["class_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["class_id"]) for i, r in got.items())


@pytest.fixture(scope="session")
def planted():
    """A large group of near copies of one text, a chain of them, and texts that share a long passage."""
    rng = np.random.default_rng(3)
    word = lambda: "w" + str(rng.integers(10**6))
    base = [word() for _ in range(200)]
    docs = []
    for i in range(60):
        x = list(base)
        for k in rng.integers(0, 200, 3):
            x[k] = word()
        docs.append(" ".join(x))
    chain = [word() for _ in range(200)]
    for i in range(8):
        chain = chain[:6 * i] + [word() for _ in range(6)] + chain[6 * i + 6:]
        docs.append(" ".join(chain))
    passage = [word() for _ in range(80)]
    docs += [" ".join([word() for _ in range(60)] + passage + [word() for _ in range(60)]) for _ in range(60)]
    return list(enumerate(docs + docs[:5]))


def test_planted_groups(spark, planted, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 7)  # buckets of more nodes are compared block by block
    docs = spark.createDataFrame(planted, "doc_id long, text string")
    want = brute_classes(planted, neardup.word_idf(docs, "text"))
    got = {r["doc_id"]: r["class_id"] for r in neardup.with_class(docs, neardup.classes(docs)).collect()}
    assert got == want
    kept = neardup.deduplicated(docs, neardup.classes(docs)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(want.values()))


def test_calls_do_not_grow_with_a_bucket(spark, monkeypatch):
    """One bucket of many nodes in different classes, and many small ones: calls stay small, and all pairs of a bucket meet once."""
    monkeypatch.setattr(neardup, "BLOCK", 10)
    monkeypatch.setattr(neardup, "BATCH_ROWS", 40)
    rows = [(7, i) for i in range(300)] + [(100 + i % 60, 1000 + i) for i in range(240)]
    out = neardup.dealt(spark.createDataFrame(rows, "bucket long, node long").withColumn("comp", F.col("node"))).toPandas()
    assert out.groupby("batch").size().max() <= 3 * 40
    assert (out[out["bucket"] == 7].groupby("batch")[["lo", "hi"]].nunique() == 1).all(axis=None)
    met = [(b, i, j) for (_, b, lo, hi), g in out.groupby(["batch", "bucket", "lo", "hi"]) for i in g["node"][g["block"] == lo] for j in g["node"][g["block"] == hi] if i < j or lo != hi]
    want = {(b, i, j) for b, i in rows for c, j in rows if b == c and i < j}
    assert len(met) == len(want) and {(b, min(i, j), max(i, j)) for b, i, j in met} == want


def test_pairs_of_a_bucket_are_linked_whatever_their_samples(spark):
    """Nodes of one bucket with no equal sample: linked if, and only if, their texts are alike enough."""
    x = [f"w{i}" for i in range(200)]
    edited = lambda step: " ".join("new" if i % step == 0 else w for i, w in enumerate(x))
    texts = [" ".join(x), edited(60), edited(12), " ".join(reversed(x))]
    idf = np.full(neardup.CELLS, 1.5)
    rows = [("a", 5, 0, 0, 0, 0, n, n, np.arange(64 * n, 64 * n + 64).tobytes(), [5] + [100 * n + k for k in range(1, neardup.BANDS)], t) for n, t in enumerate(texts)]
    schema = "batch string, bucket long, lo int, hi int, block int, band int, node long, comp long, samples binary, bands array<long>, text string"
    got = neardup.linked_in_blocks(spark.createDataFrame(rows, schema), idf).collect()
    assert [tuple(r) for r in got] == [(0, 1)]


def test_samples_estimate_the_similarity():
    rng = np.random.default_rng(0)
    x = [str(rng.integers(10**6)) for _ in range(400)]
    texts = [" ".join(x), " ".join(w if k % 60 else "new" + str(k) for k, w in enumerate(x))]
    words = neardup.Words(np.full(neardup.CELLS, 1.5))
    h, w, c = neardup.shingles(words, texts)
    s = neardup.samples(neardup.pool(), h, w, c)
    true = neardup.similarity((h[:c[0]], w[:c[0]]), (h[c[0]:], w[c[0]:]))
    assert abs((s[0] == s[1]).mean() - true) < 0.2 and 0.7 < true < 0.95


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (159, 100)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edge_rows_and_empty_table(edge, empty, edge_rows):
    found = neardup.classes(edge)
    rows = neardup.with_class(edge, found).collect()
    assert len(rows) == len(edge_rows)
    by_id = {r["doc_id"]: (r["class_id"], r["kept"]) for r in rows}
    assert by_id[1] == (1, True) and by_id[9] == (5, False) and by_id[11] == (10, False) and by_id[4] == (4, True)
    out = neardup.deduplicated(edge, found)
    assert out.columns == edge.columns and sorted(str(r["doc_id"]) for r in out.collect()) == sorted(["1", "10", "12", "2", "3", "4", "5", "6", "7", "8", "None"])
    assert neardup.deduplicated(empty, neardup.classes(empty)).count() == 0
