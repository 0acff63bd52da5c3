import hashlib

import numpy as np
import pytest

from tests.llm.conftest import SMALL
from vigil.llm import queries, suffix

L = suffix.LENGTH


def brute(docs):
    """Per document in order: (n_bytes, n_removed, n_spans, sha) by a dictionary of all strings met so far."""
    seen, out = set(), {}
    for i, t in docs:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - L + 1):
            s = raw[p:p + L]
            if s in seen:
                gone[p:p + L] = True
            seen.add(s)
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out[i] = (len(raw), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(left).hexdigest())
    return out


def check(rows, docs):
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows} == brute(docs)


def test_query_equals_brute_force(spark, small_rows):
    check(queries.QUERIES["op1_suffix_dedup"](spark, SMALL).collect(), sorted((r[0], r[1]) for r in small_rows))


@pytest.fixture(scope="session")
def planted():
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdeé "), 5))
    text = lambda n: "".join(word() for _ in range(n))
    shared = [text(60), text(25), text(20)[:100], "ab" * 90, "z" * 130]
    docs = [text(10) + shared[k % 5] + text(k % 7) + shared[(k * 3) % 5][:50 + 3 * k] + text(5) for k in range(60)]
    docs += [docs[3], "q" * 99, "q" * 100, "q" * 101, "q" * 5000, "", None, text(20), docs[7][:150], "abc" * 300, text(3000) + shared[0]]
    return list(enumerate(docs))


@pytest.mark.parametrize("hot", [4000, 1])
def test_planted_passages(spark, planted, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)  # with 1 every key of several segments is cut into single strings
    monkeypatch.setattr(suffix, "SLICE", 4096)
    check(suffix.dedup(spark.createDataFrame(planted, "doc_id long, text string")).collect(), planted)


def test_interval_expansion_equals_common_prefixes():
    rng = np.random.default_rng(4)
    for _ in range(20):
        segs = [bytes(rng.choice([97, 98], 130)) for _ in range(6)] + [b"a" * 140, b"ab" * 70]
        segs += [s[5:120] + b"x" * 10 for s in segs[:4]]
        sym = np.frombuffer(b"\0".join(s.translate(suffix.SHIFT) for s in segs) + b"\0", np.uint8)
        order = suffix.suffix_order(sym)
        rows = [sym[i:i + 128].tobytes() for i in order]
        assert rows == sorted(rows)
        limit = 12
        bounds = suffix.boundaries(sym[order - 1], limit)
        for i in range(1, len(rows)):
            a, b = rows[i - 1][:limit], rows[i][:limit]
            if len(a) == limit and 0 not in a:
                assert bounds[i] == (a != b)


def test_edge_rows_and_empty_table(edge, empty, edge_rows):
    rows = suffix.dedup(edge).collect()
    assert len(rows) == len(edge_rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[9]["n_removed"] == by_id[9]["n_bytes"] and by_id[9]["text"] == "" and by_id[11]["n_removed"] == 600
    assert by_id[4]["n_removed"] == 0 and by_id[1]["n_bytes"] == 0 and by_id[None]["n_removed"] == 0 and by_id[8]["rank"] == 7
    assert suffix.dedup(empty).count() == 0


def test_characters_that_lose_a_byte_go(spark):
    shared = "é" * 60 + "x" * 40
    docs = [(1, shared + "1"), (2, "è" + shared[1:] + "2")]
    rows = {r["doc_id"]: r for r in suffix.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    raw = docs[1][1].encode()
    kept = raw[:rows[2]["spans"][0]["lo"]] + raw[rows[2]["spans"][0]["hi"]:]
    assert rows[2]["kept_sha256"] == hashlib.sha256(kept).hexdigest() and rows[2]["text"] == kept.decode("utf-8", "ignore")
