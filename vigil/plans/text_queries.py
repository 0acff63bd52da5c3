"""Text queries: entropy, n-grams, TF-IDF over part.p_name; redaction over documents, pages, events."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.functions import redact
from vigil.functions.text import char_entropy
from vigil.operators import textfeatures as tx
from vigil.plans import sqlfrag as S
from vigil.plans.catalog import register, rnd, sql_rnd as R
from vigil.tables import table


def _entropy_sql(tbl: str, key: str, col: str) -> str:
    return f"""
    WITH c AS (SELECT {key} AS k, unnest(string_split({col}, '')) AS ch FROM {tbl} WHERE length({col}) > 0),
    n AS (SELECT k, ch, count(*) AS cnt FROM c GROUP BY ALL),
    h AS (SELECT k, sum(cnt * log2(cnt)) AS s, sum(cnt) AS len FROM n GROUP BY k)
    SELECT t.{key} AS {key},
           CASE WHEN t.{col} IS NULL THEN NULL WHEN length(t.{col}) = 0 THEN 0.0
                ELSE {R("log2(h.len) - h.s / h.len")} END AS entropy
    FROM {tbl} t LEFT JOIN h ON t.{key} = h.k
"""


@register("char_entropy", sql=_entropy_sql("part", "p_partkey", "p_name"))
def char_entropy_part(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", rnd(char_entropy(F.col("p_name"))).alias("entropy"))


@register("document_entropy", sql=_entropy_sql("documents", "doc_id", "text"))
def document_entropy(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", rnd(char_entropy(F.col("text"))).alias("entropy"))


_NGRAMS_SQL = f"""
    s AS (SELECT p_partkey AS k, {S.squeeze("lower(p_name)")} AS t FROM part),
    g AS (SELECT k, n, t, unnest(range(1, length(t) - n + 2)) AS i
          FROM s, (VALUES (1), (2), (3)) v(n) WHERE t IS NOT NULL),
    tf AS (SELECT k, substring(t, i, n) AS ngram, count(*) AS tf FROM g GROUP BY ALL)
"""


@register("char_ngram_counts", sql=f"""
    WITH {_NGRAMS_SQL}
    SELECT ngram, CAST(length(ngram) AS INTEGER) AS n, count(*) AS doc_freq, CAST(sum(tf) AS BIGINT) AS total_count
    FROM tf GROUP BY ngram
""")
def char_ngram_counts(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return tx.ngram_document_frequency(part, "p_partkey", "p_name").select("ngram", "n", "doc_freq", "total_count")


@register("tfidf_weights", sql=f"""
    WITH {_NGRAMS_SQL},
    d AS (SELECT ngram, count(*) AS doc_freq FROM tf GROUP BY ngram),
    w AS (SELECT tf.k, tf.ngram, tf.tf, tf.tf * (ln((1.0 + (SELECT count(*) FROM part)) / (1.0 + d.doc_freq)) + 1.0) AS raw
          FROM tf JOIN d ON tf.ngram = d.ngram)
    SELECT k AS p_partkey, ngram, tf, {R("raw / sqrt(sum(raw * raw) OVER (PARTITION BY k))")} AS weight FROM w
""")
def tfidf_weights(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    w = tx.tfidf_weights(part, "p_partkey", "p_name")
    return w.select("p_partkey", "ngram", "tf", rnd("weight").alias("weight"))


_URL_PAT = redact.URL_CREDENTIALS_PATTERN
_KV_PAT = redact.key_value_pattern()


def _sq(s: str) -> str:
    return s.replace("'", "''")


@register("redact_urls", sql=f"""
    SELECT page_id,
           regexp_replace(url, '{_sq(_URL_PAT)}', '\\1[REDACTED]:[REDACTED]@', 'g') AS url_redacted,
           coalesce(regexp_matches({S.strip('url')}, '^https?://'), false) AS url_ok
    FROM pages
""")
def redact_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", redact.redact_url_credentials("url").alias("url_redacted"),
                        redact.url_shape_ok("url").alias("url_ok"))


@register("redact_text", sql=f"""
    WITH r AS (SELECT doc_id, text,
        regexp_replace(regexp_replace(text, '{_sq(_URL_PAT)}', '\\1[REDACTED]:[REDACTED]@', 'g'),
                       '{_sq(_KV_PAT)}', '\\1\\2[REDACTED]', 'g') AS text_redacted
      FROM documents)
    SELECT doc_id, text_redacted, text_redacted IS DISTINCT FROM text AS was_redacted FROM r
""")
def redact_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    red = redact.redact_key_value_text(redact.redact_url_credentials("text"))
    return docs.select("doc_id", red.alias("text_redacted"),
                       (~red.eqNullSafe(F.col("text"))).alias("was_redacted"))


@register("redact_props", sql=f"""
    WITH k AS (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)
    SELECT event_id, key,
           CASE WHEN {" OR ".join(f"contains(lower(key), '{p}')" for p in redact.SENSITIVE_KEY_PARTS)}
                THEN '[REDACTED]'
                ELSE regexp_replace(json_extract_string(props, '$."' || key || '"'), '{_sq(_URL_PAT)}',
                                    '\\1[REDACTED]:[REDACTED]@', 'g') END AS value
    FROM k
""")
def redact_props(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    m = redact.redact_sensitive_map(F.from_json("props", "map<string,string>"))
    return ev.select("event_id", F.explode(m).alias("key", "value"))


@register("redact_nested", sql="""
    SELECT page_id, '{"page_id":' || page_id || ',"request":{"url":' || to_json(url)::VARCHAR || ',"headers":[{"name":"accept","auth_token":"[REDACTED]"},'
        || '{"name":' || to_json(replace(url, 'http', '[REDACTED]'))::VARCHAR || '}],"credentials":"[REDACTED]"}}' AS redacted
    FROM (SELECT page_id, replace(url, 'http', '[REDACTED]') AS url FROM pages)
""")
def redact_nested(spark, sf_dir):
    """A request log made of the pages: sensitive keys below objects and lists, and a known secret value in strings."""
    pages = table(spark, sf_dir, "pages")
    headers = F.array(F.to_json(F.struct(F.lit("accept").alias("name"), F.md5("url").alias("auth_token"))), F.to_json(F.struct(F.col("url").alias("name"))))
    body = F.concat(F.lit('{"page_id":'), "page_id", F.lit(',"request":{"url":'), F.regexp_extract(F.to_json(F.struct("url")), r'^\{"url":(.*)\}$', 1), F.lit(',"headers":['),
                    F.array_join(headers, ","), F.lit('],"credentials":{"user":"u","list":[1,2]}}}'))
    return pages.select("page_id", redact.redact_json(body, ["http"]).alias("redacted"))


@register("redact_secrets", sql="""
    SELECT doc_id, replace(replace(text, 'Licensed', '[REDACTED]'), 'the', '[REDACTED]') AS text_redacted FROM documents
""")
def redact_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", redact.redact_secret_values("text", ["the", "Licensed", ""]).alias("text_redacted"))
