"""A training corpus from raw documents: quality rules, near-dedup, suffix-array dedup, mixing, tokenizing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``. Stages work on all rows that they are given:

- quality: documents that fail the base rule or lie above a fence of their language and source go;
- near_dedup: one document of each class of copies and near copies stays;
- suffix_dedup: bytes covered by a string of 100 bytes that also starts earlier go from the texts (documents stay);
- mixing: every document is repeated as often as the mix takes it, 0 to 2 times, so repeated rows are meant;
- tokenizing: the ids of each text, and whether they decode to it again.

A table without rows passes through as one; nulls are treated as each operator states. Extra columns of any name pass
every stage unchanged (the last stage's own four columns replace columns of their names).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import bpe, mixing, neardup, quality, suffix
from vigil.llm.common import written
from vigil.llm.queries import read, tokenizer_path

WEIGHTS, SHARE, EPOCHS = [5.0, 2.0, 1.0], 1.5, 2.0


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs, neardup.classes(docs))


def by_place(docs: DataFrame) -> tuple[DataFrame, list[str], Callable[[str], str]]:
    """``docs`` under names that no operator uses, these names, and the new name of a column: extra columns never clash."""
    names = [f"__c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names, lambda c: names[docs.columns.index(c)]


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain, names, place = by_place(docs)
    left = suffix.dedup(plain, place("doc_id"), place("text"))
    if "n_chars" in docs.columns:
        left = left.withColumn(place("n_chars"), F.length(place("text")).cast("long"))
    return left.select(*names).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain, names, place = by_place(docs)
    sized = plain.withColumn("__size", mixing.word_count(place("text")))
    mixed = mixing.mix(sized, mixing.ranked_weights(plain, place("source"), WEIGHTS), place("doc_id"), place("source"), "__size", SHARE, EPOCHS)
    again = mixed.filter("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return again.select(*names).toDF(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of ``docs``, ids, n_tokens, ids_sha256 and decoded_sha256; a column of ``docs`` with one of these four names gives way."""
    plain, names, place = by_place(docs)
    coded = bpe.decode(bpe.encode(plain, tokenizer_path(), place("text")), tokenizer_path())
    result = [F.col("ids"), (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")]
    own = [F.col(n).alias(c) for n, c in zip(names, docs.columns) if c not in ("ids", "n_tokens", "ids_sha256", "decoded_sha256")]
    return coded.select(*own, *result)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("mixing", mix_sources), ("bpe", tokenize)]
#: Near-duplicate classes and interval expansion have no SQL form here; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
