"""Text regressor: char n-gram TF-IDF (+1 smooth idf, L2) ⊕ character entropy → forest / linear model.

Training, scoring and metrics are Spark ML / DataFrame jobs; the fitted model
is a ``PipelineModel`` of JVM stages (SQLTransformer, CountVectorizerModel,
ElementwiseProduct, Normalizer, VectorAssembler, regressor) and persists with
``write().save``.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer,
                                VectorAssembler, VectorSlicer)
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import LinearRegression
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.sqltext import entropy_sql, ngrams_sql, normalized_sql
from vigil.operators import forest as sparse_forest
from vigil.operators.metrics import log_target, regression_metric_columns
from vigil.operators.textfeatures import gram_frequencies

# Forest settings and n-gram range of the reference model.
FOREST = {"numTrees": 50, "maxDepth": 12, "seed": 42}
NGRAM_RANGE = (1, 3)
#: The fit reads its rows in partitions of about so many, ``FIT_PARTITIONS`` at least, dealt and sorted by the text, so a refit gives the same model.
FIT_PARTITIONS, FIT_PARTITION_ROWS = 8, 2000
LABEL, PREDICTION = "target_log", "prediction"


def fit_rows(df: DataFrame, text: str, target: str, max_rows: int | None) -> DataFrame:
    """The labelled rows (with ``max_rows`` so many at most, by hash) in an order that does not depend on how ``df`` is partitioned."""
    rows = df.select(F.col(text), F.col(target)).filter(F.col(text).isNotNull() & F.col(target).isNotNull())
    h = F.xxhash64(F.col(text))
    if max_rows is not None:
        rows = rows.orderBy(h, text, target).limit(max_rows)
    return rows.repartition(max(FIT_PARTITIONS, -(-rows.count() // FIT_PARTITION_ROWS)), h).sortWithinPartitions(text, target)


def numbered_rows(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_row``, their places 0, 1, ... in the order of the partitions."""
    number = F.monotonically_increasing_id()
    sizes = {r["p"]: r["n"] for r in rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before = [0]
    for p in range(max(sizes, default=0)):
        before.append(before[-1] + sizes.get(p, 0))
    start = F.element_at(F.array(*map(F.lit, before)), F.shiftright(number, 33).cast("int") + 1)
    return rows.withColumn("_row", (start + number.bitwiseAND((1 << 33) - 1)).cast("long"))


def corpus_counts(df: DataFrame, fit_on: DataFrame | None, text: str, n_min: int, n_max: int) -> tuple[list[str], list[int], int, int]:
    """The n-grams of all texts of ``df`` with their document frequencies, those of ``fit_on`` (none given: all) first, how many these
    are, and the number of texts.

    Counting is distributed; the fitted vectorizer then holds the vocabulary, as it must for scoring: at most the distinct
    strings of ``n_max`` characters that occur, whatever the number of rows."""
    rows = gram_frequencies(df, text, n_min, n_max)
    if fit_on is None:
        rows = rows.withColumn("fit", F.lit(True)).toArrow()
    else:
        seen = gram_frequencies(fit_on, text, n_min, n_max).select("ngram", F.lit(True).alias("fit"))
        rows = rows.join(seen, "ngram", "left").select("ngram", "doc_freq", F.coalesce("fit", F.lit(False)).alias("fit")).toArrow()
    table = sorted(zip((not f for f in rows["fit"].to_pylist()), rows["ngram"].to_pylist(), rows["doc_freq"].to_pylist()))
    return [g for _, g, _ in table], [k for _, _, k in table], sum(not late for late, _, _ in table), df.count()


def smooth_idf(doc_freq: list[int], n: int) -> list[float]:
    return [math.log((1 + n) / (1 + k)) + 1 for k in doc_freq]


def corpus_vocabulary(df: DataFrame, fit_on: DataFrame | None, text: str, n_min: int, n_max: int) -> tuple[list[str], list[float], int]:
    """The n-grams of all texts of ``df`` with their smooth idf + 1, those of ``fit_on`` first, and how many these are."""
    vocabulary, doc_freq, n_fit, n = corpus_counts(df, fit_on, text, n_min, n_max)
    return vocabulary, smooth_idf(doc_freq, n), n_fit


def fit_text_regressor(df: DataFrame, text: str, target: str, *, n_min: int = NGRAM_RANGE[0],
                       n_max: int = NGRAM_RANGE[1], max_rows: int | None = None,
                       tfidf: bool = True, model: str = "forest", reg_param: float = 1.0,
                       forest: dict | None = None) -> PipelineModel:
    """Fit on ``text`` → log10(target + 1) of all labelled rows; returns a PipelineModel that adds ``prediction``.

    ``max_rows``, where a caller gives it, bounds the rows that the regressor sees, not the corpus. Vectors are made of the whole corpus vocabulary. The regressor sees those of its entries that the fit rows have: the others are
    zero in every fit row, so no split and no coefficient could use them."""
    prep = SQLTransformer(statement=(
        f"SELECT *, {ngrams_sql('_normalized', n_min, n_max)} AS _ngrams, {entropy_sql(text)} AS _entropy "
        f"FROM (SELECT *, {normalized_sql(text)} AS _normalized FROM __THIS__)"))
    # Read several times below; kept once (recomputed from lineage if an executor is lost) and dropped when the fit is done.
    chosen = fit_rows(df, text, target, max_rows).persist(StorageLevel.MEMORY_AND_DISK)
    usable = chosen if max_rows is None else df.select(text, target).filter(F.col(text).isNotNull() & F.col(target).isNotNull())
    labeled = numbered_rows(chosen).withColumn(LABEL, log_target(F.col(target).cast("double")))
    try:
        vocabulary, doc_freq, n_fit, n = corpus_counts(usable, None if max_rows is None else chosen, text, n_min, n_max)
        cv = CountVectorizerModel.from_vocabulary(vocabulary or [""], inputCol="_ngrams", outputCol="_tf")
        stages = [prep, cv]
        feats = "_tf"
        if tfidf:
            stages += [ElementwiseProduct(scalingVec=DenseVector(smooth_idf(doc_freq, n) or [0.0]), inputCol="_tf", outputCol="_tfidf_raw"),
                       Normalizer(inputCol="_tfidf_raw", outputCol="_tfidf", p=2.0)]
            feats = "_tfidf"
        if n_fit < len(vocabulary):
            stages.append(VectorSlicer(inputCol=feats, outputCol="_fit", indices=list(range(n_fit))))
            feats = "_fit"
        stages.append(VectorAssembler(inputCols=[feats, "_entropy"], outputCol="_features"))
        featurised = PipelineModel(stages=stages).transform(labeled).select("_row", "_features", LABEL)
        if model == "forest":
            n_features = (n_fit if n_fit < len(vocabulary) else len(vocabulary or [""])) + 1
            fitted = sparse_forest.fit(labeled, featurised, n_features, sum(doc_freq) + n, features="_features", label=LABEL, prediction=PREDICTION,
                                       **dict(FOREST, **(forest or {})))
        elif model in ("linear", "ridge"):
            reg = LinearRegression(featuresCol="_features", labelCol=LABEL, predictionCol=PREDICTION,
                                   regParam=reg_param if model == "ridge" else 0.0, elasticNetParam=0.0)
            featurised.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                fitted = reg.fit(featurised)
            finally:
                featurised.unpersist()
        else:
            raise ValueError(f"unknown model {model!r}")
    finally:
        chosen.unpersist()
    return PipelineModel(stages=stages + [fitted])


def score(model: PipelineModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Batch predict; returns the input columns (or ``keep``) plus ``prediction`` (log scale)."""
    out = model.transform(df)
    cols = keep if keep is not None else df.columns
    return out.select(*cols, PREDICTION)


def scored_table(model: PipelineModel, df: DataFrame, target: str) -> DataFrame:
    """Input + target_log, prediction, prediction_error."""
    s = score(model, df).withColumn(LABEL, log_target(F.col(target).cast("double")))
    return s.withColumn("prediction_error", F.col(PREDICTION) - F.col(LABEL))


def quality_metrics(scored: DataFrame, target: str) -> DataFrame:
    """One row: rmse, mae, mean_error, abs_mean_error, prediction_mean, target_log_mean,
    prediction_target_mean_gap, positive_share, row_count, n_non_finite, n_bad_target.

    A prediction or a target (log scale) that is null, NaN or infinite counts as non-finite."""
    p, t = F.col(PREDICTION), F.col(LABEL)
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return scored.agg(
        F.sqrt(F.avg((p - F.col(LABEL)) ** 2)).alias("rmse"),
        F.avg(F.abs(p - F.col(LABEL))).alias("mae"),
        F.avg(p - F.col(LABEL)).alias("mean_error"),
        F.abs(F.avg(p - F.col(LABEL))).alias("abs_mean_error"),
        F.avg(p).alias("prediction_mean"),
        F.avg(F.col(LABEL)).alias("target_log_mean"),
        F.abs(F.avg(p) - F.avg(F.col(LABEL))).alias("prediction_target_mean_gap"),
        F.avg((F.col(target).cast("double") > 0).cast("double")).alias("positive_share"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(bad(p)).alias("n_non_finite"),
        F.count_if(bad(t)).alias("n_bad_target"),
    )


# Fixed values: (metric, threshold key) pairs checked by the quality gate, in order.
QUALITY_CHECKS = (
    ("rmse", "max_rmse"),
    ("mae", "max_mae"),
    ("abs_mean_error", "max_abs_mean_error"),
    ("prediction_target_mean_gap", "max_prediction_target_mean_gap"),
)


def quality_gate(metrics: DataFrame, thresholds: dict) -> DataFrame:
    """Rows (check_index, metric, value, threshold_name, threshold, passed, error).

    A metric strictly above its threshold fails. A table without rows, non-finite targets and non-finite predictions
    fail first and alone, in this order, as they leave nothing to compare.
    """
    q = thresholds.get("model_quality", {})
    checks = [(m, t) for m, t in QUALITY_CHECKS if t in q]
    rows = [F.struct(F.lit(i).alias("check_index"), F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"),
                     F.lit(t).alias("threshold_name"), F.lit(float(q[t])).alias("threshold"))
            for i, (m, t) in enumerate(checks)]
    # The messages of failures.
    first = (F.when(F.col("row_count") == 0, F.lit("No rows to score"))
              .when(F.col("n_bad_target") > 0, F.lit("Target log values contain non-finite values"))
              .when(F.col("n_non_finite") > 0, F.lit("Predictions contain non-finite values")))
    out = metrics.select(first.alias("_first"), F.explode(F.array(*rows)).alias("c")).select("_first", "c.*")
    above = F.when(F.col("value") > F.col("threshold"),
                   F.concat(F.lit("Model quality metric "), "metric", F.lit("="), F.format_string("%.6f", "value"),
                            F.lit(" exceeds threshold "), "threshold_name", F.lit("="), F.format_string("%.6f", "threshold")))
    error = F.coalesce("_first", above)
    return out.select("check_index", "metric", "value", "threshold_name", "threshold", error.isNull().alias("passed"), error.alias("error"))


def train_metrics(model: PipelineModel, df: DataFrame, target: str) -> DataFrame:
    s = scored_table(model, df, target)
    m = s.agg(*regression_metric_columns(LABEL, PREDICTION))
    return m.select(F.col("rmse").alias("rmse_train"), F.col("mae").alias("mae_train"),
                    F.col("abs_mean_error").alias("abs_mean_error_train"),
                    F.col("prediction_target_mean_gap").alias("prediction_target_mean_gap_train"),
                    F.col("n_rows"))


def parity(expected: DataFrame, got: DataFrame, key: str, tolerance: float = 0.05) -> DataFrame:
    """Join two scored tables on ``key``; one row: n_rows, n_missing, max_abs_error, within_tolerance."""
    j = expected.select(key, F.col(PREDICTION).alias("_e")).join(
        got.select(key, F.col(PREDICTION).alias("_g")), key, "full_outer")
    return (j.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.col("_e").isNull() | F.col("_g").isNull()).alias("n_missing"),
                  F.max(F.abs(F.col("_g") - F.col("_e"))).alias("max_abs_error"))
             .withColumn("within_tolerance", (F.col("n_missing") == 0) & (F.col("max_abs_error") <= tolerance)))
