"""Source divergence against a plain count of every term, on awkward rows and with many sources."""

import random
import re

import pytest

from vigil.llm import divergence

SCHEMA = "text string, lang string, source string, term string, item string, rank int, value long, s long, kept long"


def plain(rows, min_docs, top):
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[0] or "")), r[1] or "", r[2] or "") for r in rows]
    langs = {x: {s for _, y, s in docs if y == x} for _, x, _ in docs}
    out = []
    for x, sources in langs.items():
        df, n = {}, {s: {} for s in sources}
        for words, y, s in docs:
            if y == x:
                for w in set(words):
                    df[w] = df.get(w, 0) + 1
                for w in words:
                    n[s][w] = n[s].get(w, 0) + 1
        kept = [w for w in df if df[w] >= min_docs]

        def shares(count):
            total = sum(count.get(w, 0) for w in kept)
            return {w: 1 + 10**9 * (count.get(w, 0) + 2) // (total + 2 * len(kept)) for w in kept}

        p = {s: shares(n[s]) for s in sources}
        q = shares({w: sum(n[s].get(w, 0) for s in sources) for w in kept})
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s][w], p[o][w]) for w in kept)) for o in sources if o != s]
            terms = [(w, f(p[s][w], q[w])) for w in kept if n[s].get(w, 0) > 0 and p[s][w] > q[w]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda i: (-i[1], i[0].encode()))[:most]
                out += [(x, s, part, i, v, r) for r, (i, v) in enumerate(ranked, 1)]
    return sorted(out)


def got(spark, rows, min_docs, top):
    df = spark.createDataFrame([(*r, "a", "b", 1, 2, 3, 4) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in divergence.audit(df, min_docs, top).select("lang", "source", "part", "item", "value", "rank").collect())


def some_rows(n_sources, n=120):
    rng = random.Random(n_sources)
    words = ["a", "Ab", "abc", "abcd", "abcde", "abcdE", "abcdefgh", "abcdefghi", "x" * 40, "x" * 41, "é" * 9, "日本語", "Été", "ÉTÉ", "un\x00known", "q\u0085r"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 12))), rng.choice(["en", "fr", None]), f"s{rng.randrange(n_sources)}") for _ in range(n)]
    return rows + rows[:9] + [(None, None, None), ("", "", ""), ("lone", "tlh", "only"), ("1 2 3", "num", "x"), ("1", "num", "y"), ("y" * 100000 + " abc", "en", None)]


@pytest.mark.parametrize("n_sources, min_docs, top", [(3, 2, 10), (4, 1, 2), (2, 500, 3)])
def test_against_plain_counts(spark, n_sources, min_docs, top):
    rows = some_rows(n_sources)
    assert got(spark, rows, min_docs, top) == plain(rows, min_docs, top)


def test_blocks_of_sources(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 3)
    monkeypatch.setattr(divergence, "GROUP_ROWS", 7)
    monkeypatch.setattr(divergence, "STEP_CELLS", 20)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 100)
    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
    rows = some_rows(8)
    assert got(spark, rows, 3, 4) == plain(rows, 3, 4)


def test_empty(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
