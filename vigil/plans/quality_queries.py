"""Rule, profile and gate queries over the raw training view documents ⟕ labels
(text = documents.text, target = labels.quality as a raw string)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import profile, rules
from vigil.plans import sqlfrag as S
from vigil.plans.catalog import register, rnd, sql_rnd as R
from vigil.sources.thresholds import thresholds_table
from vigil.tables import table

TEXT, TARGET = "text", "quality"


def training_view(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return (docs.join(labels, "doc_id", "left")
                .select(F.col("text").alias(TEXT), F.col("quality").cast("string").alias(TARGET)))


_MAXLEN = rules.DEFAULT_MAX_TEXT_LENGTH
_NUM = S.numeric("quality")
_CLEAN = S.strip("text")
_FLAGS_SQL = f"""
    count(*) FILTER (WHERE text IS NULL) AS text_missing,
    count(*) FILTER (WHERE text IS NOT NULL AND {_CLEAN} = '') AS text_empty,
    count(*) FILTER (WHERE text IS NOT NULL AND {_CLEAN} <> '' AND NOT regexp_matches({_CLEAN}, '{rules.TEXT_PATTERN}')) AS text_pattern,
    count(*) FILTER (WHERE text IS NOT NULL AND (length({_CLEAN}) < 1 OR length({_CLEAN}) > {_MAXLEN})) AS text_length,
    count(*) FILTER (WHERE quality IS NULL) AS target_missing,
    count(*) FILTER (WHERE quality IS NOT NULL AND ({_NUM} IS NULL OR isnan({_NUM}))) AS target_non_numeric,
    count(*) FILTER (WHERE {_NUM} IS NOT NULL AND NOT isnan({_NUM}) AND isinf({_NUM})) AS target_infinite,
    count(*) FILTER (WHERE isfinite({_NUM}) AND {_NUM} NOT IN (0.0, 1.0)) AS target_not_allowed
"""


@register("schema_rule_violations", sql=f"""
    WITH v AS ({S.TRAINING_VIEW}), c AS (SELECT {_FLAGS_SQL} FROM v)
    SELECT rule, column_name, n_violations FROM c
    UNPIVOT (n_violations FOR rule IN (text_missing, text_empty, text_pattern, text_length,
             target_missing, target_non_numeric, target_infinite, target_not_allowed)) u
    JOIN (VALUES ('text_missing', 'text'), ('text_empty', 'text'), ('text_pattern', 'text'),
                 ('text_length', 'text'), ('target_missing', 'quality'), ('target_non_numeric', 'quality'),
                 ('target_infinite', 'quality'), ('target_not_allowed', 'quality')) m(r, column_name)
      ON u.rule = m.r
""")
def schema_rule_violations(spark, sf_dir):
    return rules.rule_violation_counts(training_view(spark, sf_dir), TEXT, TARGET)


_MSG = {r: m.format(text=TEXT, target=TARGET, max_length=_MAXLEN) for r, _, m in rules.RULES}


@register("validation_gate", sql=f"""
    WITH v AS ({S.TRAINING_VIEW}),
    s AS (SELECT count(*) AS n_rows,
                 count(*) FILTER (WHERE text IS NULL AND quality IS NULL) AS n_empty_rows,
                 count(text) AS nn_text, count(quality) AS nn_quality,
                 avg(CASE WHEN {_NUM} > 0 THEN 1.0 ELSE 0.0 END) AS positive_share,
                 {_FLAGS_SQL} FROM v),
    e AS (
      SELECT 1 AS ord, 'A' AS phase, 'DataFrame must contain at least one row' AS msg FROM s WHERE n_rows = 0
      UNION ALL SELECT 2, 'A', printf('DataFrame contains fully empty rows: %d rows', n_empty_rows) FROM s WHERE n_empty_rows > 0
      UNION ALL SELECT 3, 'A', 'DataFrame contains fully empty columns: ' ||
             concat_ws(', ', CASE WHEN nn_text = 0 THEN 'text' END, CASE WHEN nn_quality = 0 THEN 'quality' END)
             FROM s WHERE nn_text = 0 OR nn_quality = 0
      UNION ALL SELECT 10, 'B', '{_MSG["text_missing"]}' FROM s WHERE text_missing > 0
      UNION ALL SELECT 11, 'B', '{_MSG["text_empty"]}' FROM s WHERE text_empty > 0
      UNION ALL SELECT 12, 'B', '{_MSG["text_pattern"]}' FROM s WHERE text_pattern > 0
      UNION ALL SELECT 13, 'B', '{_MSG["text_length"]}' FROM s WHERE text_length > 0
      UNION ALL SELECT 14, 'B', '{_MSG["target_missing"]}' FROM s WHERE target_missing > 0
      UNION ALL SELECT 15, 'B', '{_MSG["target_non_numeric"]}' FROM s WHERE target_non_numeric > 0
      UNION ALL SELECT 16, 'B', '{_MSG["target_infinite"]}' FROM s WHERE target_infinite > 0
      UNION ALL SELECT 17, 'B', '{_MSG["target_not_allowed"]}' FROM s WHERE target_not_allowed > 0
      UNION ALL SELECT 20, 'C', printf('Column quality has invalid target distribution: positive share is %.3f; expected between 0.30 and 0.70', positive_share)
             FROM s WHERE NOT (positive_share BETWEEN 0.3 AND 0.7)),
    k AS (SELECT *, count(*) FILTER (WHERE phase = 'A') OVER () AS na,
                    count(*) FILTER (WHERE phase = 'B') OVER () AS nb FROM e)
    SELECT CAST(row_number() OVER (ORDER BY ord) - 1 AS INTEGER) AS error_index, msg AS error
    FROM k WHERE (phase = 'A') OR (phase = 'B' AND na = 0) OR (phase = 'C' AND na = 0 AND nb = 0)
""")
def validation_gate(spark, sf_dir):
    return rules.validation_errors(training_view(spark, sf_dir), TEXT, TARGET)


_PROFILE_METRICS = ("n_rows n_duplicate_rows n_missing_rows n_empty_rows n_missing_columns n_empty_columns "
                    "text_min_length text_max_length text_mean_length target_min target_max target_n_unique "
                    "positive_target_share").split()


@register("raw_profile", sql=f"""
    WITH v AS ({S.TRAINING_VIEW}),
    g AS (SELECT text, quality, count(*) AS n FROM v GROUP BY ALL),
    f AS (SELECT *, CASE WHEN isfinite({_NUM}) THEN {_NUM} END AS fin FROM g),
    p AS (SELECT
        CAST(sum(n) AS DOUBLE) AS n_rows,
        CAST(sum(n - 1) AS DOUBLE) AS n_duplicate_rows,
        CAST(coalesce(sum(CASE WHEN text IS NULL OR quality IS NULL THEN n END), 0) AS DOUBLE) AS n_missing_rows,
        CAST(coalesce(sum(CASE WHEN (text IS NULL OR {_CLEAN} = '') AND (quality IS NULL OR {S.strip('quality')} = '') THEN n END), 0) AS DOUBLE) AS n_empty_rows,
        CAST((CASE WHEN bool_or(text IS NULL) THEN 1 ELSE 0 END) + (CASE WHEN bool_or(quality IS NULL) THEN 1 ELSE 0 END) AS DOUBLE) AS n_missing_columns,
        CAST((CASE WHEN bool_and(text IS NULL OR {_CLEAN} = '') THEN 1 ELSE 0 END) + (CASE WHEN bool_and(quality IS NULL OR {S.strip('quality')} = '') THEN 1 ELSE 0 END) AS DOUBLE) AS n_empty_columns,
        CAST(min(length(text)) AS DOUBLE) AS text_min_length,
        CAST(max(length(text)) AS DOUBLE) AS text_max_length,
        sum(length(text) * n) / sum(CASE WHEN text IS NOT NULL THEN n END) AS text_mean_length,
        min(fin) AS target_min, max(fin) AS target_max,
        CAST(count(DISTINCT fin) AS DOUBLE) AS target_n_unique,
        sum(CASE WHEN fin > 0 THEN n WHEN fin IS NOT NULL THEN 0 END) / sum(CASE WHEN fin IS NOT NULL THEN n END) AS positive_target_share
      FROM f)
    SELECT metric, {R("value")} AS value FROM p UNPIVOT (value FOR metric IN ({", ".join(_PROFILE_METRICS)}))
    UNION ALL
    SELECT DISTINCT 'target_unique_value' AS metric, {R("fin")} AS value FROM f WHERE fin IS NOT NULL
""")
def raw_profile(spark, sf_dir):
    v = training_view(spark, sf_dir)
    p = profile.raw_profile(v, TEXT, TARGET)
    stacked = p.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in _PROFILE_METRICS
    ])).alias("s")).select("s.metric", rnd("s.value").alias("value"))
    uniq = profile.distinct_values(v, TARGET).select(F.lit("target_unique_value").alias("metric"),
                                                     rnd("value").alias("value"))
    return stacked.unionByName(uniq)


@register("missing_share", sql=f"""
    SELECT count(*) AS n_rows, CAST(5 AS BIGINT) AS n_columns,
           CAST(sum((doc_id IS NULL)::INT + (text IS NULL)::INT + (lang IS NULL)::INT + (source IS NULL)::INT
                    + (n_chars IS NULL)::INT) AS BIGINT) AS n_missing_cells,
           {R("sum((doc_id IS NULL)::INT + (text IS NULL)::INT + (lang IS NULL)::INT + (source IS NULL)::INT + (n_chars IS NULL)::INT) / (count(*) * 5.0)")} AS missing_share
    FROM documents
""")
def missing_share(spark, sf_dir):
    out = profile.missing_share(table(spark, sf_dir, "documents"))
    return out.withColumn("missing_share", rnd("missing_share"))


_COLUMN_CHECKS_SQL = """
    WITH a AS (SELECT count(*) AS n,
        count(*) FILTER (WHERE doc_id IS NULL) AS m0, count(*) FILTER (WHERE text IS NULL) AS m1,
        count(*) FILTER (WHERE lang IS NULL) AS m2, count(*) FILTER (WHERE source IS NULL) AS m3,
        count(*) FILTER (WHERE n_chars IS NULL) AS m4,
        coalesce(min(doc_id) = max(doc_id), true) AS k0, coalesce(min(text) = max(text), true) AS k1,
        coalesce(min(lang) = max(lang), true) AS k2, coalesce(min(source) = max(source), true) AS k3,
        coalesce(min(n_chars) = max(n_chars), true) AS k4,
        count(*) FILTER (WHERE doc_id IS DISTINCT FROM n_chars) AS d04,
        count(*) FILTER (WHERE text IS DISTINCT FROM lang) AS d12,
        count(*) FILTER (WHERE text IS DISTINCT FROM source) AS d13,
        count(*) FILTER (WHERE lang IS DISTINCT FROM source) AS d23
      FROM documents)
    SELECT 0 AS column_index, 'doc_id' AS column_name, m0 AS n_missing, m0 = n AS is_empty, k0 AS is_constant, CAST(NULL AS VARCHAR) AS duplicate_of FROM a
    UNION ALL SELECT 1, 'text', m1, m1 = n, k1, NULL FROM a
    UNION ALL SELECT 2, 'lang', m2, m2 = n, k2, CASE WHEN d12 = 0 THEN 'text' END FROM a
    UNION ALL SELECT 3, 'source', m3, m3 = n, k3, CASE WHEN d13 = 0 THEN 'text' WHEN d23 = 0 THEN 'lang' END FROM a
    UNION ALL SELECT 4, 'n_chars', m4, m4 = n, k4, CASE WHEN d04 = 0 THEN 'doc_id' END FROM a
"""


@register("column_checks", sql=_COLUMN_CHECKS_SQL)
def column_checks(spark, sf_dir):
    return profile.column_checks(table(spark, sf_dir, "documents"))


def _basic_row(i: int, value: str) -> str:
    name, cond, expected = profile.BASIC_TESTS[i]
    ok = f"{value} > {expected}" if cond == "gt" else f"{value} = {expected}"
    return (f"SELECT {i} AS test_index, '{name}' AS test_name, {value} AS value, '{cond}' AS condition, "
            f"CAST({expected} AS DOUBLE) AS expected, "
            f"CASE WHEN coalesce({ok}, false) THEN 'SUCCESS' ELSE 'FAIL' END AS status FROM s, c")


@register("basic_data_tests", sql=f"""
    WITH cc AS ({_COLUMN_CHECKS_SQL}),
    c AS (SELECT CAST(count(*) FILTER (WHERE is_empty) AS DOUBLE) AS empty_cols,
                 CAST(count(*) FILTER (WHERE duplicate_of IS NOT NULL) AS DOUBLE) AS dup_cols FROM cc),
    s AS (SELECT CAST(count(*) AS DOUBLE) AS n,
                 {R("sum((doc_id IS NULL)::INT + (text IS NULL)::INT + (lang IS NULL)::INT + (source IS NULL)::INT + (n_chars IS NULL)::INT) / (count(*) * 5.0)")} AS missing,
                 CAST(count(*) FILTER (WHERE doc_id IS NULL AND text IS NULL AND lang IS NULL AND source IS NULL
                                       AND n_chars IS NULL) AS DOUBLE) AS empty_rows
          FROM documents)
    {" UNION ALL ".join(_basic_row(i, v) for i, v in enumerate(("n", "missing", "empty_rows", "empty_cols", "dup_cols")))}
""")
def basic_data_tests(spark, sf_dir):
    """V4: the non-blocking data tests (rows, missing share, empty rows / columns, duplicated columns)."""
    out = profile.basic_data_tests(table(spark, sf_dir, "documents"))
    return out.withColumn("value", rnd("value"))


@register("thresholds_resolved", sql="""
    WITH o AS (SELECT avg(CAST(quality > 0 AS DOUBLE)) AS share, max(length(text)) AS longest FROM documents JOIN labels USING (doc_id)),
    t AS (SELECT * FROM (VALUES ('min_positive_target_share', 0.3), ('max_positive_target_share', 0.7), ('max_password_length', 128.0)) AS x(key, threshold))
    SELECT 'schema' AS section, key, CAST(threshold AS DOUBLE) AS threshold, observed,
           CASE WHEN key LIKE 'min%' THEN observed >= threshold ELSE observed <= threshold END AS passed
    FROM (SELECT key, threshold, CASE WHEN key = 'max_password_length' THEN CAST(longest AS DOUBLE) ELSE share END AS observed FROM t, o)
""")
def thresholds_resolved(spark, sf_dir):
    """The thresholds table joined with what the labelled documents show for each key."""
    seen = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").agg(
        F.avg((F.col("quality") > 0).cast("double")).alias("share"), F.max(F.length("text")).cast("double").alias("longest"))
    observed = seen.select(F.inline(F.array(*[F.struct(F.lit(k).alias("key"), F.col(c).alias("observed")) for k, c in (
        ("min_positive_target_share", "share"), ("max_positive_target_share", "share"), ("max_password_length", "longest"))])))
    low = F.col("key").startswith("min")
    return thresholds_table(spark).join(observed, "key").select(
        "section", "key", F.col("value").alias("threshold"), "observed",
        F.when(low, F.col("observed") >= F.col("value")).otherwise(F.col("observed") <= F.col("value")).alias("passed"))
