"""Model queries over labeled documents (text → quality): train + gate, batch scoring, parity.

These are iterative ML fits with no SQL form; the driver checks them rows-only.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators import model as M
from vigil.operators import ridge, sample
from vigil.operators import textfeatures as tx
from vigil.operators.metrics import log_target
from vigil.plans import sqlfrag as S
from vigil.plans.catalog import register, rnd, round_doubles, sql_rnd as R
from vigil.session import checkpoint_dir
from vigil.sources.thresholds import DEFAULT_THRESHOLDS
from vigil.tables import source_key, table

TEXT, TARGET, KEY = "text", "quality", "doc_id"
PARITY_ROUNDS = 3


def labeled(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(KEY, TEXT)
    labels = table(spark, sf_dir, "labels").select(KEY, TARGET)
    return docs.join(labels, KEY)


def _split(spark, sf_dir):
    """Labelled rows with their half; only keys are positioned, and the texts are joined to them once."""
    keys = table(spark, sf_dir, "labels").select(KEY, TARGET).join(table(spark, sf_dir, "documents").select(KEY), KEY)
    halves = sample.half_split(keys, KEY, overlap=False)
    lab = table(spark, sf_dir, "documents").select(KEY, TEXT).join(halves, KEY)
    return lab.filter(F.col("half") == "train"), lab.filter(F.col("half") == "test")


def _model_path(spark, sf_dir, kind: str) -> str:
    """A folder named after the state of the source files, so a model is fitted once for each and again when they change."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{source_key(spark, sf_dir, ['documents', 'labels'])}"


_SAVED: set[str] = set()


def fitted(spark, sf_dir):
    """Fitted on the train half and saved; queries over the same state of the files load it. Rows are put in a fixed order first, so a refit gives the same model."""
    path = _model_path(spark, sf_dir, "forest")
    if path not in _SAVED:
        M.fit_text_regressor(_split(spark, sf_dir)[0], TEXT, TARGET).write().overwrite().save(path)
        _SAVED.add(path)
    return PipelineModel.load(path)


def _dealt(df):
    """Rows dealt by a hash of the key: a table in few files, or one whose files are in order of the halves, would leave the n-grams of
    its texts to a few tasks. Dealing by the key itself is left out of the plan after a join on it, even when that turns into a broadcast."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(KEY))


@register("train_and_gate")
def train_and_gate(spark, sf_dir):
    _, test = _split(spark, sf_dir)
    scored = M.scored_table(fitted(spark, sf_dir), _dealt(test), TARGET)
    return round_doubles(M.quality_gate(M.quality_metrics(scored, TARGET), DEFAULT_THRESHOLDS))


@register("score_batch")
def score_batch(spark, sf_dir):
    docs = _dealt(table(spark, sf_dir, "documents").select(KEY, TEXT))
    # the model that passed the gate (trained on the train half) scores every document
    out = M.score(fitted(spark, sf_dir), docs, keep=[KEY])
    return out.select(KEY, rnd(M.PREDICTION).alias(M.PREDICTION))


@register("prediction_parity")
def prediction_parity(spark, sf_dir):
    """Save, reload and re-score a stratified sample in each round; worst error per round."""
    model = fitted(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/parity-model-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    reloaded = PipelineModel.load(path)
    lab = labeled(spark, sf_dir)
    picked = sample.stratified_sample(lab, KEY, TARGET, size=50)
    check = lab.join(picked.select(KEY), KEY)
    expected = M.score(model, check, keep=[KEY])
    rounds = []
    for r in range(1, PARITY_ROUNDS + 1):
        got = M.score(reloaded, check, keep=[KEY])
        rounds.append(M.parity(expected, got, KEY).withColumn("round", F.lit(r)))
    out = rounds[0]
    for x in rounds[1:]:
        out = out.unionByName(x)
    return round_doubles(out.select("round", "n_rows", "n_missing", "max_abs_error", "within_tolerance"))


# ---------------------------------------------------------------- ridge by normal equations, and the corpus dictionary

RIDGE_REG = 1.0


def _halves_sql() -> str:
    """Labelled documents by half: the first half of the ids trains, as in ``sample.half_split`` without overlap."""
    return """
    lab AS (SELECT d.doc_id, d.text, l.quality FROM documents d JOIN labels l USING (doc_id)),
    pos AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position, count(*) OVER () AS n FROM (SELECT doc_id FROM lab)),
    train AS (SELECT lab.* FROM lab JOIN pos USING (doc_id) WHERE position < n // 2),
    test AS (SELECT lab.* FROM lab JOIN pos USING (doc_id) WHERE position >= n // 2)
    """


def _grams_sql(name: str, src: str, n_max: int) -> str:
    """(doc_id, ngram, tf) of the texts of ``src``: characters with the ones after them."""
    after = ", ".join(f"lead(ch, {k}) OVER (PARTITION BY doc_id ORDER BY pos) AS c{k}" for k in range(1, n_max)) or "NULL AS c0"
    grams = " UNION ALL ".join(f"SELECT doc_id, {' || '.join(['ch'] + [f'c{k}' for k in range(1, n)])} AS ngram FROM {name}_l" + (f" WHERE c{n - 1} IS NOT NULL" if n > 1 else "") for n in range(1, n_max + 1))
    return f"""
    {name}_t AS (SELECT doc_id, string_split({S.squeeze("lower(text)")}, '') AS c FROM {src} WHERE length(text) > 0),
    {name}_p AS (SELECT doc_id, unnest(c) AS ch, unnest(range(len(c))) AS pos FROM {name}_t),
    {name}_l AS (SELECT doc_id, ch, {after} FROM {name}_p),
    {name} AS (SELECT doc_id, ngram, count(*) AS tf FROM ({grams}) GROUP BY ALL)
    """


_IDF_SQL = "ln((1.0 + (SELECT count(*) FROM train)) / (1.0 + doc_freq)) + 1.0"


@register("ngram_dictionary", sql=f"""
    WITH {_halves_sql()}, {_grams_sql("g", "train", 3)},
    f AS (SELECT ngram, count(*) AS doc_freq FROM g GROUP BY ngram)
    SELECT row_number() OVER (ORDER BY ngram) - 1 AS id, ngram, doc_freq, {R(_IDF_SQL)} AS idf FROM f
""")
def ngram_dictionary(spark, sf_dir):
    """M1 M2 M7: every n-gram of the whole train half with its id, document frequency and idf."""
    train, _ = _split(spark, sf_dir)
    return tx.ngram_dictionary(train, KEY, TEXT, *M.NGRAM_RANGE).withColumn("idf", rnd("idf"))


def _ridge_sql() -> str:
    """The fit in SQL: features, centred normal equations, and their solution by elimination, a column of the matrix at a time."""
    def entropy(src: str) -> str:
        return f"""SELECT s.doc_id, CASE WHEN length(s.text) > 0 THEN log2(length(s.text)) - e.x / length(s.text) ELSE 0.0 END AS entropy FROM {src} s LEFT JOIN (
            SELECT doc_id, sum(k * log2(k)) AS x FROM (SELECT doc_id, ch, count(*) AS k FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM {src} WHERE length(text) > 0) GROUP BY ALL) GROUP BY doc_id) e
            ON e.doc_id = s.doc_id"""

    def weights(name: str) -> str:
        return f"""{name}_raw AS (SELECT doc_id, id, tf * idf AS raw FROM {name}_n JOIN dict USING (ngram)),
            {name}_w AS (SELECT doc_id, id, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS w FROM {name}_raw
                         UNION ALL SELECT doc_id, (SELECT count(*) FROM dict), entropy FROM ({entropy(name)}))"""

    return f"""
    WITH RECURSIVE {_halves_sql()}, {_grams_sql("train_n", "train", 1)}, {_grams_sql("test_n", "test", 1)},
    freq AS (SELECT ngram, count(*) AS doc_freq FROM train_n GROUP BY ngram),
    dict AS MATERIALIZED (SELECT row_number() OVER (ORDER BY ngram) - 1 AS id, ngram, doc_freq, {_IDF_SQL} AS idf FROM freq),
    {weights("train")}, {weights("test")},
    y AS (SELECT doc_id, log10(CAST(quality AS DOUBLE) + 1) AS y FROM train),
    n AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(y) AS y_mean FROM y),
    dims AS MATERIALIZED (SELECT unnest(range((SELECT count(*) FROM dict) + 1)) AS id),
    mean AS MATERIALIZED (SELECT d.id, coalesce(sum(w), 0) / any_value(n.n) AS m FROM dims d CROSS JOIN n LEFT JOIN train_w t ON t.id = d.id GROUP BY d.id),
    xx AS (SELECT a.id AS i, b.id AS j, sum(a.w * b.w) AS v FROM train_w a JOIN train_w b USING (doc_id) GROUP BY ALL),
    xy AS (SELECT id, sum(w * y) AS v FROM train_w JOIN y USING (doc_id) GROUP BY id),
    cells AS (SELECT a.id AS i, b.id AS j, coalesce(xx.v, 0) - n.n * a.m * b.m + CASE WHEN a.id = b.id THEN {RIDGE_REG} ELSE 0 END AS v
              FROM mean a CROSS JOIN mean b CROSS JOIN n LEFT JOIN xx ON xx.i = a.id AND xx.j = b.id
              UNION ALL SELECT a.id, (SELECT count(*) FROM dims), coalesce(xy.v, 0) - n.n * a.m * n.y_mean FROM mean a CROSS JOIN n LEFT JOIN xy ON xy.id = a.id),
    matrix AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(v ORDER BY j) AS r FROM cells GROUP BY i)),
    solved AS (SELECT 0 AS k, m FROM matrix
               UNION ALL SELECT k + 1, list_transform(m, lambda row, pos: CASE WHEN pos = k + 1 THEN list_transform(row, lambda v: v / row[k + 1])
                    ELSE list_transform(list_zip(row, m[k + 1]), lambda z: z[1] - z[2] * row[k + 1] / m[k + 1][k + 1]) END) FROM solved WHERE k < len(m)),
    beta AS MATERIALIZED (SELECT unnest(range(len(m))) AS id, unnest(list_transform(m, lambda row: row[-1])) AS b FROM solved WHERE k = len(m)),
    intercept AS (SELECT any_value(n.y_mean) - sum(b * m) AS b0 FROM beta JOIN mean USING (id) CROSS JOIN n),
    scored AS (SELECT test.doc_id, any_value(b0) + coalesce(sum(w * b), 0) AS prediction, any_value(log10(CAST(quality AS DOUBLE) + 1)) AS target_log
               FROM test CROSS JOIN intercept LEFT JOIN test_w USING (doc_id) LEFT JOIN beta USING (id) GROUP BY test.doc_id)
    """


_RIDGE_SQL = _ridge_sql()


def ridge_model(spark, sf_dir):
    path = _model_path(spark, sf_dir, "ridge")
    if path not in _SAVED:
        ridge.save(ridge.fit(_split(spark, sf_dir)[0], KEY, TEXT, TARGET, reg=RIDGE_REG), path)
        _SAVED.add(path)
    return ridge.load(spark, path)


@register("ridge_coefficients", sql=f"""{_RIDGE_SQL}
    SELECT coalesce(ngram, CASE WHEN id = (SELECT count(*) FROM dict) THEN '<entropy>' END) AS feature, {R("b")} AS coefficient FROM beta LEFT JOIN dict USING (id)
    UNION ALL SELECT '<intercept>', {R("b0")} FROM intercept
""")
def ridge_coefficients(spark, sf_dir):
    """M6: the fitted model as rows; features without n-gram in angle brackets."""
    model = ridge_model(spark, sf_dir)
    rest = spark.createDataFrame([("<entropy>", model.entropy), ("<intercept>", model.intercept)], "feature string, coefficient double")
    return model.dictionary.select(F.col("ngram").alias("feature"), "coefficient").unionByName(rest).withColumn("coefficient", rnd("coefficient"))


@register("ridge_scores", sql=f"""{_RIDGE_SQL}
    SELECT doc_id, {R("prediction")} AS prediction FROM scored
""")
def ridge_scores(spark, sf_dir):
    """M8: the ridge model's predictions for the test half."""
    out = ridge.score(ridge_model(spark, sf_dir), _split(spark, sf_dir)[1].select(KEY, TEXT), KEY, TEXT)
    return out.select(KEY, rnd("prediction").alias("prediction"))


_GATE_SQL = " UNION ALL ".join(
    f"SELECT {i} AS check_index, '{m}' AS metric, {R(v)} AS value, '{t}' AS threshold_name, CAST({DEFAULT_THRESHOLDS['model_quality'][t]} AS DOUBLE) AS threshold, "
    f"{v} <= {DEFAULT_THRESHOLDS['model_quality'][t]} AS passed, CASE WHEN {v} > {DEFAULT_THRESHOLDS['model_quality'][t]} THEN 'Model quality metric {m}=' || printf('%.6f', {v}) || "
    f"' exceeds threshold {t}=' || printf('%.6f', {DEFAULT_THRESHOLDS['model_quality'][t]}) END AS error FROM q"
    for i, (m, t, v) in enumerate((m, t, {"rmse": "rmse", "mae": "mae", "abs_mean_error": "ame", "prediction_target_mean_gap": "gap"}[m]) for m, t in M.QUALITY_CHECKS))


@register("ridge_gate", sql=f"""{_RIDGE_SQL},
    q AS (SELECT sqrt(avg((prediction - target_log) ** 2)) AS rmse, avg(abs(prediction - target_log)) AS mae, abs(avg(prediction - target_log)) AS ame,
                 abs(avg(prediction) - avg(target_log)) AS gap FROM scored)
    {_GATE_SQL}
""")
def ridge_gate(spark, sf_dir):
    """V5 V6: the quality gate over the ridge model's scores of the test half."""
    _, test = _split(spark, sf_dir)
    scored = ridge.score(ridge_model(spark, sf_dir), test.select(KEY, TEXT, TARGET), KEY, TEXT).withColumn(M.LABEL, log_target(F.col(TARGET).cast("double")))
    return round_doubles(M.quality_gate(M.quality_metrics(scored, TARGET), DEFAULT_THRESHOLDS))


@register("ridge_parity", sql=f"""{_RIDGE_SQL}
    SELECT CAST(round AS INTEGER) AS round, (SELECT count(*) FROM scored) AS n_rows, 0::BIGINT AS n_missing, 0.0::DOUBLE AS max_abs_error, true AS within_tolerance FROM range(1, {PARITY_ROUNDS + 1}) t(round)
""")
def ridge_parity(spark, sf_dir):
    """The saved and reloaded ridge model scores the whole test half as the fitted one, in each round."""
    model = ridge_model(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/ridge-{uuid.uuid4().hex}"
    ridge.save(model, path)
    test = _split(spark, sf_dir)[1].select(KEY, TEXT)
    expected = ridge.score(model, test, KEY, TEXT)
    rounds = [M.parity(expected, ridge.score(ridge.load(spark, path), test, KEY, TEXT), KEY).withColumn("round", F.lit(r)) for r in range(1, PARITY_ROUNDS + 1)]
    return round_doubles(reduce(DataFrame.unionByName, rounds).select("round", "n_rows", "n_missing", "max_abs_error", "within_tolerance"))
