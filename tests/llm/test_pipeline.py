import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import SMALL
from tests.llm.test_mixing import brute_targets
from tests.llm.test_neardup import brute_classes
from vigil.llm import neardup, suffix
from vigil.llm.common import written


def without_repeats(docs):
    """The text of each document without the bytes that a string of 100 bytes standing earlier covers."""
    seen, out = set(), {}
    for i, t in sorted(docs.items()):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - suffix.LENGTH + 1):
            s = raw[p:p + suffix.LENGTH]
            if s in seen:
                gone[p:p + suffix.LENGTH] = True
            seen.add(s)
        out[i] = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore") if gone.any() else t or ""
    return out


def test_stages_equal_brute_force(spark, small_rows):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, out = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SMALL)))
        if name != "bpe":
            assert out[-1].columns == columns
    raw, good, unique, cut, mixed, coded = ([r.asDict() for r in d.collect()] for d in out)
    text = {r["doc_id"]: r["text"] for r in raw}

    # quality: some go, none that is labelled good and passes the base rule
    kept = {r["doc_id"] for r in good}
    assert kept < set(text) and all(r["text"] == text[r["doc_id"]] for r in good)
    fine = {r["doc_id"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 1").collect()}
    for i in fine & set(text) - kept:
        words = text[i].split()
        windows = Counter(zip(words, words[1:], words[2:]))
        assert len(words) < 50 or max(windows.values()) > 1

    classes = brute_classes([(i, text[i]) for i in sorted(kept)], neardup.word_idf(out[1].select("text"), "text"))
    assert sorted(r["doc_id"] for r in unique) == sorted(set(classes.values()))
    want = without_repeats({r["doc_id"]: r["text"] for r in unique})
    assert {r["doc_id"]: r["text"] for r in cut} == want and all(r["n_chars"] == len(r["text"]) for r in cut)

    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in want.items()}
    source = {r["doc_id"]: r["source"] for r in cut}
    sizes, taken = defaultdict(int), defaultdict(int)
    for i in size:
        sizes[source[i]] += size[i]
    target = brute_targets(sizes, {s: [5, 2, 1][k % 3] for k, s in enumerate(sorted(sizes))}, 1.5 * sum(sizes.values()), 2)
    for r in mixed:
        assert r["text"] == want[r["doc_id"]]
        taken[r["source"]] += size[r["doc_id"]]
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 2
    assert all(abs(taken[s] - target[s]) <= max(size[i] for i in size if source[i] == s) for s in sizes)

    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    key = lambda r: (r["doc_id"], r["text"])
    assert Counter(map(key, coded)) == Counter(map(key, mixed))
    for r in coded:
        ids = lib.encode(r["text"], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_extra_columns_pass_every_stage(spark, edge):
    """Columns named like inner and output columns of the operators come out as they went in."""
    extra = ["doc", "target", "copies", "taken", "source_size", "spans", "n_removed", "n_bytes", "n_spans", "kept_sha256", "__size", "size", "weight", "node", "class_id", "text_md5",
             "cut_slice", "whole", "extra", "decoded", "n_words", "base_failed", "kept", "value", "rate", "bucket", "fence", "lo", "hi", "key", "rows", "__key", "__text"]
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars").filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    fine = spark.createDataFrame([(50 + k, " ".join(f"w{i}x{k}" for i in range(60)), "en", "s", 1) for k in range(4)], docs.schema)
    docs = docs.unionByName(fine)
    tagged = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in extra])
    for name, stage in corpus_pipeline.STAGES:
        plain, more = stage(spark, written(docs), SMALL), stage(spark, written(tagged), SMALL)
        assert more.columns == docs.columns + extra + (["ids", "n_tokens", "ids_sha256", "decoded_sha256"] if name == "bpe" else [])
        rows = [r.asDict() for r in more.collect()]
        assert rows and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in extra), name
        if name != "mixing":  # rows tie by all their columns there
            assert Counter(map(str, plain.collect())) == Counter(str(Row(**{c: r[c] for c in plain.columns})) for r in rows), name


def test_run_on_edge_rows_and_an_empty_table(spark, edge, empty, tmp_path):
    fine = [(50 + k, " ".join(f"w{i}x{k}" for i in range(60)), None, [None, "s"][k % 2], 1, 7, None, None) for k in range(4)]
    for name, df in (("edge", edge.unionByName(spark.createDataFrame(fine, edge.schema))), ("empty", empty)):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        rows = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert {r["text"] for r in rows} <= {r[1] for r in fine} and bool(rows) == (name == "edge")
