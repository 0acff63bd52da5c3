"""Character n-gram tables and TF-IDF weights as DataFrame jobs.

TF-IDF follows the smooth-idf, "+1" convention: idf = ln((1 + n) / (1 + df)) + 1,
weight = tf * idf, then each document's weights are scaled to unit L2 norm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.text import char_entropy, ngrams_from_chars, ngrams_from_text, normalized_chars, normalized_text, run_lengths
from vigil.operators.ordered import numbered
from vigil.session import cut_lineage

#: Rows of a document-frequency table that is broadcast at most: some 20 MB of short strings and counts.
MAX_BROADCAST_NGRAMS = 200_000


def exploded_ngrams(df: DataFrame, key: str, text: str, n_min: int = 1, n_max: int = 3) -> DataFrame:
    """(key, ngram) — one row per n-gram occurrence; generated inside the task, no shuffle."""
    chars = df.select(key, normalized_chars(F.col(text)).alias("_chars"))
    return chars.select(key, F.explode(ngrams_from_chars("_chars", n_min, n_max)).alias("ngram"))


#: Characters of text a slice: a task counts the n-grams of about so many characters, whatever the size of the table.
CHARS_PER_SLICE = 500_000


def dealt_by_key(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text) dealt by key into slices of about ``CHARS_PER_SLICE`` characters, as many as the session's shuffle partitions at least."""
    chars = df.agg(F.sum(F.length(text))).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(key, text).repartition(max(least, -(-chars // CHARS_PER_SLICE)), F.col(key))


def ngram_term_counts(df: DataFrame, key: str, text: str, n_min: int = 1, n_max: int = 3) -> DataFrame:
    """(key, ngram, tf): occurrences per document. The texts are dealt by key, so their n-grams, many times larger, are counted
    where they are made: they cross no shuffle, and a task holds those of one slice."""
    return (exploded_ngrams(dealt_by_key(df, key, text), key, text, n_min, n_max)
            .groupBy(key, "ngram").agg(F.count(F.lit(1)).alias("tf")))


def ngram_document_frequency(df: DataFrame, key: str, text: str, n_min: int = 1, n_max: int = 3) -> DataFrame:
    """(ngram, n, doc_freq, total_count) over all documents."""
    tf = ngram_term_counts(df, key, text, n_min, n_max)
    return (tf.groupBy("ngram")
              .agg(F.count(F.lit(1)).alias("doc_freq"), F.sum("tf").alias("total_count"))
              .withColumn("n", F.length("ngram")))


def tfidf_weights(df: DataFrame, key: str, text: str, n_min: int = 1, n_max: int = 3,
                  n_docs: int | None = None) -> DataFrame:
    """(key, ngram, tf, idf, weight) with smooth idf + 1 and per-document L2 normalisation.

    The document-frequency table is written first, so its size is known: it is broadcast up to ``MAX_BROADCAST_NGRAMS`` rows,
    beyond that both sides are sorted and merged. The plan's own estimate is no guide: it takes the exploded n-grams to be no
    larger than the texts, and would broadcast them.
    """
    if n_docs is None:
        n_docs = df.select(key).count()
    tf = ngram_term_counts(df, key, text, n_min, n_max)
    dfreq = cut_lineage(tf.groupBy("ngram").agg(F.count(F.lit(1)).alias("doc_freq")))
    dfreq = dfreq.hint("broadcast" if dfreq.count() <= MAX_BROADCAST_NGRAMS else "merge")
    idf = F.log((F.lit(1.0 + n_docs)) / (F.lit(1.0) + F.col("doc_freq"))) + F.lit(1.0)
    w = tf.join(dfreq, "ngram").withColumn("idf", idf).withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return w.select(key, "ngram", "tf", "idf", (F.col("raw") / norm).alias("weight"))


def with_entropy(df: DataFrame, text: str, out: str = "entropy") -> DataFrame:
    return df.withColumn(out, char_entropy(F.col(text)))


def document_grams(df: DataFrame, key: str, text: str, n_min: int = 1, n_max: int = 3) -> DataFrame:
    """(key, ngram, tf): the distinct n-grams of each row's text, counted inside the row, so nothing is shuffled.

    The rows are dealt by key first: a table stored in one file would give all the work to one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chars = df.select(key, text).repartition(n, key).select(key, normalized_chars(F.col(text)).alias("_chars"))
    grams = chars.select(key, ngrams_from_chars("_chars", n_min, n_max).alias("_grams"))
    return grams.select(key, F.inline(run_lengths("_grams"))).select(key, F.col("value").alias("ngram"), F.col("n").cast("long").alias("tf"))


def gram_frequencies(df: DataFrame, text: str, n_min: int = 1, n_max: int = 3) -> DataFrame:
    """(ngram, doc_freq) over all rows of ``df``, each n-gram counted once a row before anything is shuffled."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = df.select(text).repartition(n).select(normalized_text(F.col(text)).alias("_text")).select(ngrams_from_text("_text", n_min, n_max).alias("_grams"))
    return texts.select(F.explode(F.array_distinct("_grams")).alias("ngram")).groupBy("ngram").agg(F.count(F.lit(1)).alias("doc_freq"))


def ngram_dictionary(df: DataFrame, key: str, text: str, n_min: int = 1, n_max: int = 3, grams: DataFrame | None = None) -> DataFrame:
    """(id, ngram, doc_freq, idf) of every n-gram of all texts: ids are places in the n-grams' order, smooth idf + 1.

    Document frequencies are summed in the tasks before they are shuffled by n-gram; ids come from ranges of the sorted
    n-grams, so neither the dictionary nor its numbering passes one task or the driver. Rows with a null text count as documents."""
    grams = document_grams(df, key, text, n_min, n_max) if grams is None else grams
    n_docs = df.count()
    counts = grams.groupBy("ngram").agg(F.count(F.lit(1)).alias("doc_freq"))
    idf = F.log((F.lit(1.0 + n_docs)) / (F.lit(1.0) + F.col("doc_freq"))) + F.lit(1.0)
    return numbered(counts, ["ngram"], "id").select("id", "ngram", "doc_freq", idf.alias("idf"))


def sparse_weights(grams: DataFrame, dictionary: DataFrame, key: str, tfidf: bool = True) -> DataFrame:
    """(key, id, weight) of the dictionary's n-grams in ``grams`` (key, ngram, tf): tf times idf scaled to unit length per key, or tf
    alone. N-grams that the dictionary lacks count for nothing, neither in the length."""
    hit = grams.join(dictionary, "ngram")
    if not tfidf:
        return hit.select(key, "id", F.col("tf").cast("double").alias("weight"))
    raw = hit.select(key, "id", (F.col("tf") * F.col("idf")).alias("raw"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.select(key, "id", (F.col("raw") / length).alias("weight"))


def sparse_vectors(weights: DataFrame, key: str) -> DataFrame:
    """(key, ids, weights): each key's entries as two arrays in ascending order of id. An entry is a distinct n-gram of one text."""
    entries = F.array_sort(F.collect_list(F.struct("id", "weight")))
    return weights.groupBy(key).agg(entries.alias("e")).select(key, F.col("e.id").alias("ids"), F.col("e.weight").alias("weights"))
