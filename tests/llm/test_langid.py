from pyspark.sql import functions as F

from tests.llm.conftest import SMALL
from vigil.llm import langid, queries


def test_held_out_accuracy(spark):
    out = queries.QUERIES["op9_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert out.count() == docs.count()
    row = out.join(docs, "doc_id").filter("held_out and text rlike '[a-z]'").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("hit"), F.min("score"), F.max("score")).first()
    assert row["hit"] > 0.97 and 0 <= row[1] <= row[2] <= 1


def test_spans_of_mixed_text(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.train(docs)
    en, de = (docs.filter(f"lang = '{x}' and length(text) between 300 and 3000").orderBy("doc_id").first()["text"] for x in ("en", "de"))
    row = langid.label(spark.createDataFrame([(en + " " + de,)], "text string"), model).first()
    spans, n = row["spans"], len(langid.WORDS((en + " " + de).lower()))
    assert spans[0]["first_word"] == 0 and spans[-1]["last_word"] == n - 1
    assert all(a["last_word"] + 1 == b["first_word"] and a["lang"] != b["lang"] for a, b in zip(spans, spans[1:]))
    cut = len(langid.WORDS(en.lower()))
    share = lambda x, lo, hi: sum(min(s["last_word"] + 1, hi) - max(s["first_word"], lo) for s in spans if s["lang"] == x and s["first_word"] < hi and s["last_word"] >= lo) / (hi - lo)
    assert share("en", 0, cut) > 0.8 and share("de", cut, n) > 0.8


def test_rare_languages_are_learned_at_every_size(spark):
    rows = [(i, f"word and deed {i}", "en" if i % 2 else "de") for i in range(1200)] + [(5000 + i, f"rare{i} text", f"x{i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = sorted(r["lang"] for r in docs.filter(~langid.held_out("doc_id")).select("lang").distinct().collect())
    assert len(want) > 12 and langid.train(docs, max_docs=100)["langs"] == want == langid.train(docs, max_docs=5)["langs"]
    assert langid.even_share([1, 2, 500, 700], 103) == 50 and langid.even_share([3, 4], 10) == 4 and langid.even_share([], 5) == 0


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, w, x) for i in range(60) for w, x in ((f"слово и дело мир {i}", "ru"), (f"word and deed peace {i}", "en"), (f"κόσμος και λόγος {i}", "el"))]
    model = langid.train(spark.createDataFrame([(100 * i + k, t, x) for k, (i, t, x) in enumerate(rows)], "doc_id long, text string, lang string"))
    out = langid.label(spark.createDataFrame([("деду",), ("zzz",), ("ζζζ",), ("12 34",), (None,)], "text string"), model).collect()
    assert [r["lang_pred"] for r in out] == ["ru", "en", "el", "und", "und"]


def test_edge_rows_and_empty_tables(edge, empty, edge_rows):
    model = langid.train(edge)
    out = langid.label(edge, model).collect()
    assert len(out) == len(edge_rows) and all(r["lang_pred"] == "und" and r["score"] == 0 for r in out if not (r["text"] or "").strip())
    assert langid.label(empty, model).count() == 0
    assert {r["lang_pred"] for r in langid.label(edge, langid.train(empty)).collect()} == {"und"}


def test_more_languages_than_a_byte_counts(spark):
    """200 languages of one word each: all are told apart, and their spans name them."""
    words = ["".join(chr(97 + (i * k) % 26) for k in (1, 3, 7, 11, 17)) + chr(97 + i // 26) * 3 for i in range(200)]
    rows = [(i + 200 * j, " ".join([w] * 8), f"l{i:03d}") for i, w in enumerate(words) for j in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df)
    assert len(model["langs"]) > 190
    out = langid.label(df, model).collect()
    assert all(s["lang"] in model["langs"] for r in out for s in r["spans"])
    known = [r for r in out if r["lang"] in model["langs"]]
    assert sum(r["lang_pred"] == r["lang"] for r in known) > 0.95 * len(known)
