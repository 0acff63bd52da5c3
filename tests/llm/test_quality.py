import re
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.conftest import SMALL
from vigil.llm import quality, queries
from vigil.llm.common import written


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    hit = {j for i, w in enumerate(windows) if twice[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_stats_equal_brute_force(edge_rows, small_rows):
    for text in [r[1] for r in edge_rows + small_rows] + ["a b c a b c", "a\n\na\n b\nb", "x y z x y", "a a a a"]:
        assert quality.stats_of(text or "")[:5] == brute(text)


def test_verdict_on_the_given_table(spark, small_rows):
    out = {r["doc_id"]: r for r in queries.QUERIES["op2_quality_rules"](spark, SMALL).collect()}
    assert len(out) == len(small_rows)
    for i, text, *_ in small_rows:
        n, chars, symbols, dups, repeats = brute(text)
        assert (out[i]["n_words"], out[i]["word_chars"], out[i]["n_symbols"], out[i]["n_dup_lines"], out[i]["n_repeat_words"]) == (n, chars, symbols, dups, repeats)
        assert out[i]["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        assert not (out[i]["base_failed"] and out[i]["kept"])
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    clean = [out[r["doc_id"]] for r in labels if r["quality"] == 1 and r["doc_id"] in out]
    assert all(r["kept"] or r["base_failed"] for r in clean)


def test_fences_follow_the_group(spark):
    """Symbols that are usual in one source are no reason to reject there, and are elsewhere."""
    word = lambda k, i: f"w{(i * 7919 + k * 31) % 99991}" + ("#" if k % 2 else "")
    rows = [(k, " ".join(word(k, i) for i in range(60)), "en", "code" if k % 2 else "prose") for k in range(600)] + [(1001, " ".join(word(1, i) for i in range(60)), "en", "prose")]
    stats = written(quality.text_stats(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")))
    kept = {r["doc_id"]: r["kept"] for r in quality.verdict(stats).collect()}
    assert not kept.pop(1001) and all(kept.values())


def test_sketches_merge_by_adding(spark, small_rows):
    rated = quality.with_rates(written(quality.text_stats(spark.createDataFrame([r for r in small_rows], "doc_id long, text string, lang string, source string"))))
    key = lambda df: sorted(map(str, df.select("lang", "rate", "bucket", "n").collect()))
    assert key(quality.merged(quality.sketch(rated, ["lang", "source"]), ["lang"])) == key(quality.sketch(rated, ["lang"]))
    exact = rated.filter(~F.col("base_failed")).groupBy("lang").agg(F.percentile("chars_per_word", 0.5).alias("m")).collect()
    fence = {(r["lang"]): r for r in quality.fences(quality.sketch(rated, ["lang"]), ["lang"]).filter("rate = 'chars_per_word'").collect()}
    for r in exact:
        assert fence[r["lang"]]["fence"] >= r["m"]


def test_edge_rows_and_empty_table(edge, empty, edge_rows):
    assert quality.verdict(written(quality.text_stats(edge))).count() == len(edge_rows)
    assert quality.verdict(written(quality.text_stats(empty))).count() == 0


def test_rows_that_are_all_alike_stay(spark):
    """A group of equal rows rejects nothing, also where words are very long, and one row far above them goes."""
    texts = {"cjk": " ".join(chr(0x4E00 + i) * 700 for i in range(60)), "loud": " ".join(f"AB#{i}" for i in range(60)), "plain": " ".join(f"w{i}x" for i in range(60))}
    rows = [(k, texts[s], "x", s) for s in texts for k in range(250)] + [(9999, " ".join(f"#w{i}" for i in range(60)), "x", "plain")]
    judged = quality.verdict(written(quality.text_stats(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))))
    assert {r["doc_id"] for r in judged.filter("NOT kept").collect()} == {9999}
