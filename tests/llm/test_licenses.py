import re

from tests.llm.conftest import SMALL
from vigil.llm import licenses, queries


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text):
    ws, starts, base = words(text), [], []
    for label, phrase in licenses.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(ws)) if ws[i:i + len(p)] == p]
        starts += at
        base += [label] * bool(at)
    found, score = set(base), 1.0 if base else 0.0
    for line in (text or "").split("\n"):
        have = set(words(line))
        for label, t in licenses.TEMPLATES:
            want = set(words(t))
            met = len(want & have) / len(want)
            if met >= licenses.THRESHOLD:
                found.add(label)
                score = max(score, met)
    return len(ws), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(found)), score


def check(rows, texts):
    key = lambda x: str(x)
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], round(r["score"], 9)) for r in rows), key=key)
    assert got == sorted(((i, *brute(t)[:6], round(brute(t)[6], 9)) for i, t in texts), key=key)


def test_query_equals_brute_force(spark, small_rows):
    check(queries.QUERIES["op10_license_scan"](spark, SMALL).collect(), [(r[0], r[1]) for r in small_rows])


def test_no_pair_is_lost_by_the_filters(spark):
    """Blocks with words left out, doubled and in another order; joined and counted against all pairs."""
    texts = []
    for n, (_, t) in enumerate(licenses.TEMPLATES):
        ws = words(t)
        for k in range(len(ws)):
            texts.append((100 * n + k, " ".join(reversed(ws[:k] + ws[k + 1:] + ws[:1] + ["extra"] * k))))
    check(licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect(), texts)


def test_wrapped_notices(spark):
    """A notice is found however its lines are wrapped, and not across a blank line."""
    texts, want = [], []
    for n, (label, t) in enumerate(licenses.TEMPLATES):
        ws = t.split()
        for k, width in enumerate((1, 2, 3, 5)):
            lines = [" ".join(ws[i:i + width]) for i in range(0, len(ws), width)]
            texts += [(10 * n + k, "before\n\n# " + "\n# ".join(lines) + "\n \nafter")]
            want.append(label)
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert all(label in got[i]["labels"].split(",") and got[i]["score"] == 1.0 for (i, _), label in zip(texts, want))
    apart = "This is free and unencumbered\n\nsoftware released into the public domain"
    assert licenses.scan(spark.createDataFrame([(1, apart)], "doc_id long, text string")).first()["labels"] == ""


def test_edge_rows_and_empty_table(edge, empty, edge_rows):
    check(licenses.scan(edge).collect(), [(r[0], r[1]) for r in edge_rows])
    assert licenses.scan(empty).count() == 0
