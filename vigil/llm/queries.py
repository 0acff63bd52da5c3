"""The registered queries of the training-data operators, one module of this package for each operator's own work."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import bpe, dawg, divergence, fingerprint, langid, licenses, mixing, neardup, oracles, packing, quality, suffix, toxicity, warc
from vigil.llm.common import held_out, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op7_minhash_near_dedup")
def op7(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.with_class(docs, neardup.classes(docs))


@register("op8_bpe_encode_decode")
def op8(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    back = bpe.decode(bpe.encode(docs, tokenizer_path()).drop("text"), tokenizer_path())
    return back.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op1_suffix_dedup", oracles.SUFFIX)
def op1(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.dedup(docs, with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register("op2_quality_rules", oracles.QUALITY)
def op2(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    judged = quality.verdict(written(quality.text_stats(docs).drop("text")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *quality.RATES)


@register("op3_fingerprints", oracles.FINGERPRINTS)
def op3(spark, sf_dir):
    x = fingerprint.with_next(read(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.length("text")
    k = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - k), F.substring(F.col("next_start"), F.lit(1), k))
    facts = fingerprint.let(edited, lambda e: F.struct(F.sha2(e, 256).alias("edited_sha256"), fingerprint.fingerprint(e).alias("edited_fingerprint")))
    x = x.withColumn("n_chars", n.cast("long")).withColumn("facts", facts).select("doc_id", "n_chars", "facts.*", "fingerprint", "next_fingerprint")
    return x.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    fingerprint.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    fingerprint.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


@register("op4_toxicity")
def op4(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "spans")


@register("op5_warc_dictionary", oracles.WARC)
def op5(spark, sf_dir):
    manifest = warc.write_archives(read(spark, sf_dir, "pages"), min_bytes=0)
    return warc.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op6_mixing", oracles.MIXING)
def op6(spark, sf_dir):
    docs = written(read(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("size")))
    mixed = mixing.mix(docs, mixing.ranked_weights(docs, "source", [5.0, 2.0, 1.0]), "doc_id", "source", "size", share=1.5, epochs=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@register("op9_language_id")
def op9(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    labelled = langid.label(docs.select("doc_id", "text"), langid.train(docs.select("doc_id", "text", "lang")))
    return labelled.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@register("op10_license_scan", oracles.LICENSES)
def op10(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, "doc_id", "text")


@register("op13_conversation_repair", oracles.CONVERSATIONS)
def op13(spark, sf_dir):
    given = read(spark, sf_dir, "conversations")
    reports, repaired = dawg.repair(dawg.damaged(given))
    found = reports.join(dawg.digests(repaired).withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left")
    every = given.select(F.col("conv_id").alias("every")).distinct()
    x = every.join(found, F.col("every").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return x.select(F.col("every").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


@register("op12_source_divergence", oracles.DIVERGENCE)
def op12(spark, sf_dir):
    return divergence.audit(read(spark, sf_dir, "documents").select("text", "lang", "source"), min_docs=10, top=10)


@register("op11_best_fit_packing")
def op11(spark, sf_dir):
    packed, _ = packing.pack(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), size=1024, end=2)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
