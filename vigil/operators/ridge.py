"""Ridge regression on sparse text features by normal equations, over all rows.

Features are the TF-IDF weights (or counts) of a dictionary's n-grams and the entropy of the text. Each task adds up, for its
rows, the products of all pairs of features (the Gram matrix), the sums of features and their products with the target; the
matrices of the tasks meet as blocks, added by (block row, block column) in a shuffle, so no task holds more than one row of
blocks from each other. The sums are centred (an intercept that is not penalised), ``reg`` is added to the diagonal, and the
system, as large as the number of features squared, is solved on the driver. ``MAX_FEATURES`` bounds it: a larger dictionary
is an error, not a cut; take shorter n-grams for this model, the forest takes any.

A row without target is not fitted on; a null or empty text has no n-grams and entropy 0, and is scored by the rest. A text
that stands in several rows is used as often. A table without rows cannot be fitted (an error); scoring it gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.text import char_entropy
from vigil.operators import textfeatures as tx
from vigil.operators.metrics import log_target
from vigil.session import cut_lineage

MAX_FEATURES = 4096
#: Rows and columns of a block of the Gram matrix, and entries of the texts that are multiplied at once.
BLOCK, CHUNK_ROWS = 256, 2048


@dataclass
class RidgeModel:
    """Coefficients by feature: ``dictionary`` (id, ngram, doc_freq, idf, coefficient), one for the entropy, and the intercept."""

    dictionary: DataFrame
    entropy: float
    intercept: float
    n_range: tuple[int, int]
    tfidf: bool


def _moments(rows: DataFrame, p: int) -> tuple[np.ndarray, np.ndarray]:
    """X'X and X'y for the columns 0..p of x = (features, entropy, 1), from rows (ids, weights, entropy, y), as a (p + 2)-matrix with y last."""
    size = p + 3  # features, entropy, one, target

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(lo, CHUNK_ROWS)
                x = np.zeros((part.num_rows, size))
                ids, weights = part.column("ids"), part.column("weights")
                lens = np.array([0 if v is None else v for v in pa.compute.list_value_length(ids).to_pylist()], np.int64)
                x[np.repeat(np.arange(len(lens)), lens), ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)] = weights.flatten().to_numpy(zero_copy_only=False)
                x[:, p] = part.column("entropy").to_numpy(zero_copy_only=False)
                x[:, p + 1] = 1.0
                x[:, p + 2] = part.column("y").to_numpy(zero_copy_only=False)
                total += x.T @ x
        for i in range(0, size, BLOCK):
            for j in range(i, size, BLOCK):
                block = np.ascontiguousarray(total[i:i + BLOCK, j:j + BLOCK])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([block.ravel().tolist()], pa.list_(pa.float64()))], names=["i", "j", "block"])

    blocks = rows.select("ids", "weights", "entropy", "y").mapInArrow(run, "i int, j int, block array<double>")
    # one row a cell: sums are combined in the tasks that made the blocks, then by block
    cells = blocks.select("i", "j", F.posexplode("block").alias("k", "v")).groupBy("i", "j", "k").agg(F.sum("v").alias("v"))
    out = np.zeros((size, size))
    for r in cells.groupBy("i", "j").agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("c")).toLocalIterator():  # a bounded number of blocks of a bounded size
        i, j = r["i"], r["j"]
        block = np.array([c["v"] for c in r["c"]]).reshape(min(BLOCK, size - i), min(BLOCK, size - j))
        out[i:i + BLOCK, j:j + BLOCK] = block
        out[j:j + BLOCK, i:i + BLOCK] = block.T
    return out[:p + 2, :p + 2], out[:p + 2, p + 2]


def features(df: DataFrame, key: str, text: str, dictionary: DataFrame, n_range: tuple[int, int], tfidf: bool, grams: DataFrame | None = None) -> DataFrame:
    """``df`` with ids, weights (null for a text without n-grams) and entropy. Keys must be distinct."""
    grams = tx.document_grams(df, key, text, *n_range) if grams is None else grams
    vectors = tx.sparse_vectors(tx.sparse_weights(grams, dictionary.select("id", "ngram", "idf"), key, tfidf), key)
    return df.join(vectors, key, "left").withColumn("entropy", F.coalesce(char_entropy(text), F.lit(0.0)))


def fit(df: DataFrame, key: str, text: str, target: str, reg: float = 1.0, n_range: tuple[int, int] = (1, 1), tfidf: bool = True) -> RidgeModel:
    """Fit ``log10(target + 1)`` on all rows of ``df`` that have a target; ``reg`` 0 is plain least squares (least norm where columns depend)."""
    rows = df.filter(F.col(target).isNotNull()).select(key, text, target)
    grams = cut_lineage(tx.document_grams(rows, key, text, *n_range))  # read for the dictionary and for the vectors
    dictionary = cut_lineage(tx.ngram_dictionary(rows, key, text, *n_range, grams=grams))
    p = dictionary.count()
    if p > MAX_FEATURES:
        raise ValueError(f"{p} n-grams: normal equations take at most {MAX_FEATURES}; use shorter n-grams or the forest")
    x = features(rows, key, text, dictionary, n_range, tfidf, grams).withColumn("y", log_target(F.col(target).cast("double")))
    xx, xy = _moments(x, p)
    n = xx[p + 1, p + 1]
    if not n:
        raise ValueError("no rows with a target")
    mean = xx[:p + 1, p + 1] / n
    y_mean = xy[p + 1] / n
    centred = xx[:p + 1, :p + 1] - n * np.outer(mean, mean)
    right = xy[:p + 1] - n * mean * y_mean
    system = centred + reg * np.eye(p + 1)
    beta = np.linalg.solve(system, right) if reg else np.linalg.lstsq(system, right, rcond=None)[0]
    spark = df.sparkSession
    coefficients = spark.createDataFrame([(i, float(b)) for i, b in enumerate(beta[:p])], "id long, coefficient double")
    return RidgeModel(cut_lineage(dictionary.join(F.broadcast(coefficients), "id")), float(beta[p]), float(y_mean - mean @ beta), n_range, tfidf)


def score(model: RidgeModel, df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` with ``prediction`` (log scale). Keys must be distinct. A text's weights meet their coefficients as rows, summed by key."""
    grams = tx.document_grams(df, key, text, *model.n_range)
    hit = grams.join(F.broadcast(model.dictionary) if model.dictionary.count() <= MAX_FEATURES else model.dictionary, "ngram")
    raw = F.col("tf") * F.col("idf") if model.tfidf else F.col("tf").cast("double")
    length = F.sqrt(F.sum(raw * raw)) if model.tfidf else F.lit(1.0)
    part = hit.groupBy(key).agg((F.sum(raw * F.col("coefficient")) / length).alias("_text"))
    full = df.join(part, key, "left")
    value = F.lit(model.intercept) + F.lit(model.entropy) * F.coalesce(char_entropy(text), F.lit(0.0)) + F.coalesce("_text", F.lit(0.0))
    return full.withColumn("prediction", value).drop("_text")


def save(model: RidgeModel, path: str) -> None:
    """Two tables under ``path``: the dictionary with its coefficients, and one row for the rest."""
    model.dictionary.write.mode("errorifexists").parquet(f"{path}/dictionary")
    row = [(model.entropy, model.intercept, model.n_range[0], model.n_range[1], model.tfidf)]
    model.dictionary.sparkSession.createDataFrame(row, "entropy double, intercept double, n_min int, n_max int, tfidf boolean").coalesce(1).write.mode("errorifexists").parquet(f"{path}/model")


def load(spark, path: str) -> RidgeModel:
    r = spark.read.parquet(f"{path}/model").first()
    return RidgeModel(spark.read.parquet(f"{path}/dictionary"), r["entropy"], r["intercept"], (r["n_min"], r["n_max"]), r["tfidf"])
