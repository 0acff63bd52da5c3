import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vigil.functions import redact
from vigil.functions.text import char_entropy, char_ngrams, strip_ws
from vigil.operators import textfeatures as tx

WORDS = ["", "a", "aa", "ab", "abc", "password", "qwerty", "hello world", "Été  ça\tva", "zzzzzzzzzz"]


def py_entropy(s):
    if not s:
        return 0.0
    n = len(s)
    return -sum((c / n) * math.log2(c / n) for c in Counter(s).values())


def py_ngrams(s, lo=1, hi=3):
    import re
    s = re.sub(r"\s\s+", " ", s.lower())
    return [s[i:i + n] for n in range(lo, hi + 1) for i in range(len(s) - n + 1)]


def test_entropy_matches_python(spark):
    df = spark.createDataFrame([(w,) for w in WORDS], "s string")
    got = {r.s: r.e for r in df.select("s", char_entropy("s").alias("e")).collect()}
    for w in WORDS:
        assert abs(got[w] - py_entropy(w)) < 1e-12
        assert 0.0 <= got[w] <= (math.log2(len(w)) + 1e-12 if w else 0.0)
    assert math.copysign(1.0, got[""]) == 1.0  # no -0.0


def test_entropy_null(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(char_entropy("s")).collect()[0][0] is None


def test_ngrams_match_python(spark):
    df = spark.createDataFrame([(w,) for w in WORDS], "s string")
    got = {r.s: r.g for r in df.select("s", char_ngrams("s").alias("g")).collect()}
    for w in WORDS:
        assert got[w] == py_ngrams(w)
        norm = py_ngrams(w, 1, 1)
        assert len(got[w]) == sum(max(0, len(norm) - n + 1) for n in (1, 2, 3))


def test_tfidf_unit_norm_and_idf(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "abc"), (3, "b")], "k int, s string")
    w = tx.tfidf_weights(df, "k", "s").collect()
    norms = Counter()
    for r in w:
        norms[r.k] += r.weight ** 2
    assert all(abs(v - 1.0) < 1e-12 for v in norms.values())
    idf_a = [r.idf for r in w if r.ngram == "a"][0]
    assert abs(idf_a - (math.log(4 / 3) + 1)) < 1e-12  # smooth idf + 1, n=3, df=2


def test_ml_tfidf_matches_sql_form(spark):
    from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer
    from pyspark.ml.linalg import DenseVector
    df = spark.createDataFrame([(1, "ab"), (2, "abc"), (3, "b"), (4, "cab")], "k int, s string")
    g = df.select("k", char_ngrams("s").alias("g"))
    cv = CountVectorizer(inputCol="g", outputCol="tf").fit(g)
    t = cv.transform(g)
    idf = IDF(inputCol="tf", outputCol="x").fit(t)
    ew = ElementwiseProduct(scalingVec=DenseVector(idf.idf.toArray() + 1), inputCol="tf", outputCol="r")
    out = Normalizer(inputCol="r", outputCol="v", p=2.0).transform(ew.transform(t))
    vocab = cv.vocabulary
    ml = {(r.k, vocab[i]): v for r in out.collect() for i, v in zip(r.v.indices, r.v.values)}
    sql = {(r.k, r.ngram): r.weight for r in tx.tfidf_weights(df, "k", "s").collect()}
    assert ml.keys() == sql.keys()
    assert all(abs(ml[k] - sql[k]) < 1e-12 for k in ml)


def test_strip_unicode(spark):
    df = spark.createDataFrame([("　  x y \n\x0b",)], "s string")
    assert df.select(strip_ws("s")).collect()[0][0] == "x y"


@pytest.mark.parametrize("url,expected", [
    ("https://user:pass@host/x", "https://[REDACTED]:[REDACTED]@host/x"),
    ("http://host/x", "http://host/x"),
    ("see ftp://a:b@c and s3://d:e@f", "see ftp://[REDACTED]:[REDACTED]@c and s3://[REDACTED]:[REDACTED]@f"),
])
def test_url_credentials(spark, url, expected):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(redact.redact_url_credentials("u")).collect()[0][0] == expected


def test_secret_values_longest_first(spark):
    df = spark.createDataFrame([("token abc123 and abc",)], "s string")
    out = df.select(redact.redact_secret_values("s", ["abc", "abc123"])).collect()[0][0]
    assert out == "token [REDACTED] and [REDACTED]"


def test_sensitive_map_and_text(spark):
    df = spark.createDataFrame([('{"password_min_length": "8", "api_key": "x", "name": "https://u:p@h"}',)], "j string")
    m = df.select(redact.redact_sensitive_map(F.from_json("j", "map<string,string>")).alias("m")).collect()[0].m
    assert m["password_min_length"] == "[REDACTED]" and m["api_key"] == "[REDACTED]"
    assert m["name"] == "https://[REDACTED]:[REDACTED]@h"
    t = spark.createDataFrame([('x token = "abc" y; Secret: zz, other=1',)], "s string")
    out = t.select(redact.redact_key_value_text("s")).collect()[0][0]
    assert out == "x token = [REDACTED] y; Secret: [REDACTED], other=1"


def test_url_shape(spark):
    df = spark.createDataFrame([(" https://a ",), ("ftp://x",), ("",), (None,)], "u string")
    assert [r[0] for r in df.select(redact.url_shape_ok("u")).collect()] == [True, False, False, False]


def test_parse_helpers(spark):
    from vigil.functions.parse import split_list, truthy
    df = spark.createDataFrame([(" a, ,b ,", "Yes")], "l string, t string")
    r = df.select(split_list("l").alias("l"), truthy("t").alias("t")).collect()[0]
    assert r.l == ["a", "b"] and r.t is True


def test_redact_json_at_every_depth(spark):
    rows = [('{"outer":{"password":"hunter2"},"list":[{"token":"t0k"},"see http://u:p@h/x"],"n":1.5,"ok":null}',),
            ('not json password=hunter2 abc123',), (None,), ('["abc123", {"API_KEY": {"a": 1}}]',), ("[" * 5000,)]
    got = [r[0] for r in spark.createDataFrame(rows, "j string").select(redact.redact_json("j", ["abc123"])).collect()]
    assert got[0] == '{"outer":{"password":"[REDACTED]"},"list":[{"token":"[REDACTED]"},"see http://[REDACTED]:[REDACTED]@h/x"],"n":1.5,"ok":null}'
    assert got[1] == "not json password=[REDACTED] [REDACTED]" and got[2] is None
    assert got[3] == '["[REDACTED]",{"API_KEY":"[REDACTED]"}]' and got[4] == "[" * 5000


def test_redact_json_against_a_plain_walk(spark):
    """Random JSON of any shape: the engine's fold equals a walk over the parsed value."""
    import json
    import random
    import re

    rng = random.Random(11)
    words = ["password", "my_KEY", "name", "a", "to\\ken", 'to"ken', "é", "list", "credentials", "", "x\n", "\\", '"', ":", "{}", "[", "http://u:p@h", "abc123 z", " "]

    def make(depth):
        kind = rng.randrange(6 if depth else 4)
        if kind == 4:
            return {w: make(depth - 1) for w in rng.sample(words, rng.randrange(4))}
        if kind == 5:
            return [make(depth - 1) for _ in range(rng.randrange(4))]
        return [rng.choice(words), rng.randrange(-5, 9), None, rng.choice([True, 1.5])][kind]

    def walk(v):
        if isinstance(v, dict):
            return {k: "[REDACTED]" if any(p in k.lower() for p in redact.SENSITIVE_KEY_PARTS) else walk(x) for k, x in v.items()}
        if isinstance(v, list):
            return [walk(x) for x in v]
        return re.sub(r"(://)([^/\s:@]+):([^@/\s]+)@", r"\1[REDACTED]:[REDACTED]@", v).replace("abc123", "[REDACTED]") if isinstance(v, str) else v

    values = [make(5) for _ in range(150)] + [{"password": {"a": ["}", {"b": "]"}], "c": "x"}, "z": [{"key": []}, {"key": {}}, 1]}, [[], {}, ""]]
    rows = [(i, json.dumps(v, ensure_ascii=bool(i % 2), indent=i % 3 or None)) for i, v in enumerate(values)]
    got = {r["i"]: r["j"] for r in spark.createDataFrame(rows, "i int, j string").select("i", redact.redact_json("j", ["abc123"]).alias("j")).collect()}
    for i, v in enumerate(values):
        assert json.loads(got[i]) == walk(v), rows[i][1]
    plan = spark.createDataFrame(rows, "i int, j string").select(redact.redact_json("j"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tfidf_never_broadcasts_the_exploded_ngrams(spark, monkeypatch):
    df = spark.createDataFrame([(1, "ab"), (2, "abc"), (2, "b"), (None, "cab"), (3, None)], "k int, s string")
    small = {(r.k, r.ngram): (r.tf, r.weight) for r in tx.tfidf_weights(df, "k", "s").collect()}
    monkeypatch.setattr(tx, "MAX_BROADCAST_NGRAMS", 0, raising=False)
    w = tx.tfidf_weights(df, "k", "s")
    assert "Broadcast" not in plan_of(w) and "SortMergeJoin" in plan_of(w)
    merged = {(r.k, r.ngram): (r.tf, r.weight) for r in w.collect()}
    assert merged.keys() == small.keys() and (2, "b") in merged and merged[2, "b"][0] == 2 and (None, "ca") in merged
    assert all(merged[k][0] == small[k][0] and abs(merged[k][1] - small[k][1]) < 1e-12 for k in small)


def test_ngrams_are_counted_in_slices_of_texts(spark, monkeypatch):
    monkeypatch.setattr(tx, "CHARS_PER_SLICE", 10, raising=False)
    df = spark.createDataFrame([(i, "abcde") for i in range(40)] + [(1, "ab"), (None, "ab"), (None, "ab")], "k int, s string")
    tf = tx.ngram_term_counts(df, "k", "s")
    assert tf.rdd.getNumPartitions() >= 20  # as many as the characters need, whatever the input's partitions
    assert "hashpartitioning(k#" in plan_of(tf) and not re.search(r"hashpartitioning\([^)]*ngram", plan_of(tf))  # the texts are shuffled by key, the n-grams are not
    counts = {(r.k, r.ngram): r.tf for r in tf.collect()}
    assert counts[1, "ab"] == 2 and counts[None, "ab"] == 2 and counts[0, "cde"] == 1 and len(counts) == 40 * 12 + 3
    assert {r.ngram: (r.doc_freq, r.total_count) for r in tx.ngram_document_frequency(df, "k", "s").collect()}["ab"] == (41, 43)


def test_run_lengths_sort_values_without_a_comparison_expression(spark):
    from vigil.functions.sqltext import entropy_sql, run_lengths_sql
    from vigil.functions.text import run_lengths
    df = spark.createDataFrame([("banana",), ("",), (None,), ("é日a日",)], "s string")
    out = df.select("s", run_lengths(F.split("s", "")).alias("a"), F.expr(run_lengths_sql("split(s, '')")).alias("b"), F.expr(entropy_sql("s")).alias("e"))
    assert "array_sort" not in plan_of(out) and "lambda left" not in plan_of(out)
    for r in out.filter("s IS NOT NULL").collect():
        assert [tuple(x) for x in r.a] == sorted(Counter(r.s or [""]).items()) and r.a == r.b


def test_model_text_expressions_evaluate_nothing_for_each_place(spark):
    """N-grams and entropy of the model's SQL are cut by patterns: equal to the element-wise forms, also for null, characters beyond 16 bits and bytes that are no UTF-8."""
    from vigil.functions.sqltext import entropy_sql, ngrams_sql, normalized_sql
    from vigil.functions.text import ngrams_from_chars, ngrams_from_text, normalized_chars, normalized_text
    texts = WORDS + [None, "a", "😀", "😀😀", "x😀y😀", "a\n\r\nb \t c", "ÀBİß", "日本日本語", "\x00a", "$1\\1"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    df = df.unionAll(spark.sql("SELECT CAST(X'61FF62FE62' AS STRING) AS s UNION ALL SELECT CAST(X'F09F98' AS STRING)"))
    df = df.select("s", F.expr(normalized_sql("s")).alias("t"), normalized_text("s").alias("u"), normalized_chars("s").alias("c"))
    out = df.select("s", F.expr(ngrams_sql("t")).alias("a"), ngrams_from_text("u").alias("b"), ngrams_from_text("u", 2, 2).alias("two"))
    assert "lambda" not in plan_of(out)
    both = df.select("s", F.expr(ngrams_sql("t")).alias("a"), ngrams_from_text("u").alias("b"), ngrams_from_chars("c").alias("want"),
                     F.expr(entropy_sql("s")).alias("e"), char_entropy("s").alias("h")).collect()
    assert len(both) == len(texts) + 2 and all(r.a == r.b == r.want and r.e == r.h for r in both)
    assert dict(out.select("s", "two").collect())["x😀y😀"] == ["x😀", "😀y", "y😀"]
    assert "regexp_extract_all(array_join(sort_array(" in plan_of(df.select(F.expr(entropy_sql("s")).alias("e")))
