"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF shingles, banded, verified exactly.

A document's set has its shingles of five words (all its words, if fewer), each with weight tf * idf. A shingle's idf
is the mean over its words, 1 for a word of every document up to 2 for a word of one; document frequencies are counted
over all documents, in CELLS cells of hashed words. Similarity is the weighted Jaccard coefficient, the sum of the
smaller weights by the sum of the larger ones; documents of similarity THRESHOLD or more are linked, and linked
documents form a class. Equal texts are one node from the start, so copies cost nothing.

1. BANDS * ROWS consistent samples of each set; ROWS equal samples put two nodes in one bucket of a band.
2. In each bucket all nodes are verified against the smallest node, then, where they are in other classes still,
   against HUBS nodes drawn by a hash: rows in proportion to the nodes, however large the bucket.
3. Nodes of one bucket that are in different classes still are compared in blocks of BLOCK nodes, inside the tasks:
   first by a bound that their similarity cannot exceed, then exactly. So no pair that shares a bucket is lost, and only
   links leave a task as rows.

Null texts are classes of their own. Texts without words equal only their copies. Rows with one doc_id are one
document, in one class; a null id has no say in the class id, which is the smallest doc_id of the class. Tables
without rows give none; only the two columns are read.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import Vocabulary, arrow_columns, cut_batch, offsets, ragged, texts_of, written
from vigil.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 16, 4
CELLS = 1 << 18
POOL = 1 << 16
BLOCK = 512
BATCH_ROWS = 2000
PARTS = 256
HUBS = 8
CACHE_WORDS = 150_000
#: Bytes of text whose shingles a task holds at once.
SLICE_BYTES = 1_000_000
MIX = np.random.default_rng(11).integers(1, 2**63, SHINGLE + BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def pool() -> tuple[np.ndarray, ...]:
    """The random numbers of consistent weighted sampling, drawn once: r and c from Gamma(2, 1), b uniform. A shingle and
    a sample choose an entry by a hash, so all documents draw alike."""
    rng = np.random.default_rng(7)
    r, c, b = rng.gamma(2, 1, POOL), rng.gamma(2, 1, POOL), rng.random(POOL)
    return tuple(x.astype(np.float32) for x in (1 / r, b, r, np.log(c) + r * (b - 1)))


class Words:
    """Hash (64 bits) and idf of words; remembers words up to a bound."""

    def __init__(self, idf: np.ndarray | None):
        self.idf_of_cell = idf
        self.forget()

    def forget(self):
        self.number, self.hash, self.idf = Vocabulary(), np.zeros(0, np.uint64), np.zeros(0)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.number) > CACHE_WORDS:
            self.forget()
        find = self.number.__getitem__
        found = [np.array(list(map(find, t.encode().split())), np.int64) for t in texts]
        if self.number.fresh:
            h = np.array([xxhash.xxh3_64_intdigest(w) for w in self.number.fresh], np.uint64)
            self.hash = np.concatenate([self.hash, h])
            if self.idf_of_cell is not None:
                self.idf = np.concatenate([self.idf, self.idf_of_cell[(h >> np.uint64(40)) % np.uint64(CELLS)]])
            self.number.fresh = []
        return np.concatenate([np.zeros(0, np.int64), *found]), np.array([len(f) for f in found], np.int64)


def shingles(words: Words, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, weight) of the distinct shingles of all texts, text by text and ascending, and how many each text has."""
    ids, lens = words(texts)
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(0), np.zeros(len(texts), np.int64)
    at, n = offsets(lens)[:-1], np.where(lens >= SHINGLE, lens - SHINGLE + 1, np.minimum(lens, 1))
    start = np.repeat(at - offsets(n)[:-1], n) + np.arange(n.sum())
    owner = np.repeat(np.arange(len(texts)), n)
    size = np.minimum(lens, SHINGLE)[owner]
    h, idf = np.zeros(len(start), np.uint64), np.zeros(len(start))
    for k in range(SHINGLE):
        inside = k < size
        w = ids[np.where(inside, start + k, start)]
        h += np.where(inside, self_mix(words.hash[w]) * MIX[k], 0)
        idf += np.where(inside, words.idf[w], 0)
    h = self_mix(h) >> np.uint64(20)
    order = np.argsort((owner.astype(np.uint64) << np.uint64(44)) | h, kind="stable")
    h, idf, owner = h[order], (idf / size)[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]))
    return h[first], idf[first] * np.diff(np.append(first, len(h))), np.bincount(owner[first], minlength=len(texts))


def self_mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX[0]
    return x ^ (x >> np.uint64(29))


def samples(table, h: np.ndarray, weight: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Consistent samples (texts with shingles x BANDS * ROWS): shingle and quantised weight of the least draw, as 40 bits."""
    at = offsets(counts[counts > 0])[:-1]
    inv_r, b, r, c = table
    log_w, out = np.log(weight).astype(np.float32), np.zeros((len(at), BANDS * ROWS), np.int64)
    for k in range(BANDS * ROWS):
        x = h * MIX[SHINGLE + k]
        i = (x >> np.uint64(48)).astype(np.int64)
        t = np.floor(log_w * inv_r[i] + b[i])
        draw = ((c[i] - r[i] * t) * np.float32(65536)).astype(np.int64)
        name = ((x >> np.uint64(7)) ^ (t.astype(np.int64).astype(np.uint64) * MIX[1])) & np.uint64((1 << 40) - 1)
        out[:, k] = np.minimum.reduceat((draw << 40) | name.astype(np.int64), at) & ((1 << 40) - 1)
    return out


def band_keys(s: np.ndarray) -> np.ndarray:
    """One key for each band of ROWS samples; the band's number is part of it."""
    keys = np.zeros((len(s), BANDS), np.uint64)
    for k in range(BANDS * ROWS):
        keys[:, k // ROWS] = self_mix(keys[:, k // ROWS] ^ (s[:, k].astype(np.uint64) * MIX[SHINGLE + k]))
    return keys.view(np.int64)


def word_idf(df: DataFrame, text: str) -> np.ndarray:
    """idf by cell of hashed words, from the document frequencies in all rows; CELLS numbers come to the driver."""
    def count(batches):
        words, total = Words(None), np.zeros(CELLS, np.int64)
        rows = 0
        for batch in batches:
            for part in cut_batch(batch, [text], SLICE_BYTES):
                ids, lens = words(texts_of(part.column(0)))
                n = max(len(words.number), 1)
                pairs = np.unique(np.repeat(np.arange(len(lens)), lens) * n + ids)
                total += np.bincount(((words.hash[pairs % n] >> np.uint64(40)) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
                rows += len(lens)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(cells, -1)), pa.array(np.append(total[cells], rows))], names=["cell", "n"])

    got = df.select(text).mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    found = np.zeros(CELLS + 1)
    found[got["cell"]] = got["n"]
    n_docs, n = found[-1] + 1, found[:-1] + 1
    return 2 - np.log(np.minimum(n, n_docs)) / np.log(max(n_docs, 2))


def sampled(df: DataFrame, idf: np.ndarray, text: str = "text") -> DataFrame:
    """``df`` with ``samples`` (BANDS * ROWS 64-bit numbers, binary) and ``bands`` (array of keys), null without words."""
    shared = df.sparkSession.sparkContext.broadcast(idf)
    fields = T.StructType([T.StructField("samples", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def make():
        words, table = Words(shared.value), pool()

        def run(col):
            h, w, counts = shingles(words, texts_of(col))
            has = counts > 0
            s = samples(table, h, w, counts) if has.any() else np.zeros((0, BANDS * ROWS), np.int64)
            keys, raw, row = band_keys(s), [None] * len(col), 0
            for i in np.flatnonzero(has):
                raw[i] = s[row].tobytes()
                row += 1
            at = pa.array(offsets(has * BANDS), pa.int32())
            bands = pa.ListArray.from_arrays(at, pa.array(keys.ravel(), pa.int64()), mask=pa.array(~has))
            return [pa.array(raw, pa.binary()), bands]

        return run

    return arrow_columns(df, [text], fields, make, SLICE_BYTES)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard coefficient of two sets (ascending hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - both
    return float(both / total) if total else 0.0


def verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """The pairs (a, b) of nodes whose texts have similarity THRESHOLD or more."""
    shared = pairs.sparkSession.sparkContext.broadcast(idf)
    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches):
        words = Words(shared.value)

        @functools.lru_cache(64)
        def features(text):
            h, w, _ = shingles(words, [text])
            return h, w

        for batch in batches:
            for part in cut_batch(batch, ["ta", "tb"], SLICE_BYTES):
                a, b, ta, tb = (part.column(i).to_pylist() for i in range(4))
                hit = [similarity(features(x), features(y)) >= THRESHOLD for x, y in zip(ta, tb)]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, h in zip(v, hit) if h], pa.int64()) for v in (a, b)], names=["a", "b"])

    return written(joined.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long"))


def linked_in_blocks(rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """The linked pairs (a, b) of each bucket's nodes in two blocks (or one) whose classes differ.

    A pair is looked at in the first band that it shares. Shingles fall into PARTS parts by their hash; the smaller weights
    of two nodes' parts add up to at least their common weight, so only pairs whose sum is enough are compared shingle
    by shingle. Each node's shingles are made once a group; only links leave the task.
    """
    shared = rows.sparkSession.sparkContext.broadcast(idf)

    def links(batch: pd.DataFrame) -> pd.DataFrame:
        words = Words(shared.value)
        out = [x for _, group in batch.groupby(["bucket", "lo", "hi"], sort=False) for x in links_of(group, words)]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    def links_of(group: pd.DataFrame, words: Words) -> list[tuple[int, int]]:
        bands = np.array(group["bands"].tolist())
        node, comp, block, band = (group[c].to_numpy() for c in ("node", "comp", "block", "band"))
        lo, hi = group["lo"].iloc[0], group["hi"].iloc[0]
        right, near = np.flatnonzero(block == hi), {}
        for i in np.flatnonzero(block == lo):
            j = right[((node[right] > node[i]) | (lo != hi)) & (comp[right] != comp[i])]
            j = j[(bands[j] == bands[i]).argmax(axis=1) == band[i]]
            if len(j):
                near[i] = j

        if not near:
            return []
        # only texts that have such a partner are taken apart
        used = np.unique(np.concatenate([np.array(list(near), np.int64), *near.values()]))
        h, w, n = shingles(words, group["text"].iloc[used].tolist())
        part = np.repeat(np.arange(len(n)), n) * PARTS + (h % np.uint64(PARTS)).astype(np.int64)
        parts = np.bincount(part, w, len(n) * PARTS).reshape(-1, PARTS)
        at, size, out = offsets(n), parts.sum(axis=1), []
        for i, j in near.items():
            x, y = np.searchsorted(used, i), np.searchsorted(used, j)
            most = np.minimum(parts[y], parts[x]).sum(axis=1)
            able = most * (1 + THRESHOLD) >= THRESHOLD * (size[x] + size[y]) * (1 - 1e-9)
            j, y = j[able], y[able]
            if not len(j):
                continue
            theirs, own = ragged(at[y], n[y]), slice(at[x], at[x + 1])
            place = np.minimum(np.searchsorted(h[own], h[theirs]), n[x] - 1)
            common = np.where(h[own][place] == h[theirs], np.minimum(w[own][place], w[theirs]), 0)
            both = np.add.reduceat(common, offsets(n[y])[:-1]) if len(theirs) else np.zeros(0)
            out += [(min(node[i], node[k]), max(node[i], node[k])) for k in j[both >= THRESHOLD * (size[x] + size[y] - both)]]
        return out

    return rows.groupBy("batch").applyInPandas(links, "a long, b long")


def classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per distinct text: text_md5, node (its smallest id), rows (copies), class_id (smallest id of the class)."""
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).filter(F.col("text").isNotNull()).withColumn("text_md5", F.md5("text"))
    idf = word_idf(docs, "text")
    rows = written(sampled(docs, idf).drop("text", "samples"))
    node = F.coalesce(F.min("id"), F.xxhash64("text_md5")).alias("node")
    nodes = written(rows.groupBy("text_md5").agg(node, F.count(F.lit(1)).alias("rows"), F.any_value("bands").alias("bands")))

    placed = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    hubs = placed.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").drop("high")
    placed = written(placed.join(hubs, "bucket"))
    # texts of the nodes that share a bucket
    wanted = nodes.join(placed.select("node").distinct(), "node").select("node", "text_md5")
    texts = written(docs.select("id", "text_md5", "text").join(wanted, "text_md5").filter(F.coalesce("id", "node") == F.col("node")).select("node", "text").groupBy("node").agg(F.any_value("text").alias("text")))

    star = placed.filter("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    edges = verified(star, texts, idf)
    comps = components(edges)
    apart = mixed(placed, comps)
    drawn = apart.groupBy("bucket").agg(*[F.min_by(F.struct("node", "comp"), F.xxhash64(F.lit(r), "node")).alias(f"h{r}") for r in range(HUBS)])
    star = (apart.join(drawn.select("bucket", F.explode(F.array(*[f"h{r}" for r in range(HUBS)])).alias("hub")).distinct(), "bucket").filter("comp <> hub.comp")
            .select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct())
    edges = edges.unionByName(verified(star, texts, idf))
    comps = components(edges)
    # what is left: buckets with nodes of several classes, compared in blocks
    apart = mixed(placed, comps)
    apart = dealt(apart).join(nodes.select("node", "bands"), "node").join(texts, "node").select("batch", "bucket", "lo", "hi", "block", "band", "node", "comp", "bands", "text")
    comps = components(edges.unionByName(linked_in_blocks(apart, idf)))
    return nodes.join(comps, "node", "left").select("text_md5", "node", "rows", F.coalesce("comp", "node").alias("class_id"))


def dealt(apart: DataFrame) -> DataFrame:
    """The rows of ``apart`` once for each block that their own is compared with (lo, hi), and the call (``batch``) of each.

    A bucket of one block shares its call with others, dealt by a hash: about BATCH_ROWS rows, counted over such buckets
    only. In a larger bucket each two blocks are a call of their own, so no call grows with the bucket.
    """
    sizes = apart.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select("bucket", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("n_blocks"))
    n_small = sizes.filter("n_blocks = 1").agg(F.sum("n")).first()[0] or 0
    rows = apart.join(sizes.drop("n"), "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    shared = F.concat(F.lit("shared "), F.pmod(F.xxhash64("bucket"), F.lit(max(1, n_small // BATCH_ROWS))))
    return rows.withColumn("batch", F.when(F.col("n_blocks") == 1, shared).otherwise(F.concat_ws(" ", "bucket", "lo", "hi"))).drop("n_blocks", "other")


def mixed(placed: DataFrame, comps: DataFrame) -> DataFrame:
    """Bucket rows (with their class ``comp``) of the buckets whose nodes are not all in one class."""
    own = placed.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    several = own.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 < c1").select("bucket")
    return written(own.join(several, "bucket"))


def with_class(df: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, class_id and kept of each row of ``df``: kept is the document that gives a class its id, and null texts."""
    rows = df.select(F.col(key), F.md5(text).alias("text_md5"))
    joined = rows.join(found.select("text_md5", "class_id", "node"), "text_md5", "left")
    own = F.coalesce(F.col(key).cast("long"), F.col("node"))
    return joined.select(key, F.coalesce("class_id", F.col(key).cast("long")).alias("class_id"), F.coalesce(own == F.col("class_id"), F.lit(True)).alias("kept"))


def deduplicated(df: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one document of each class. Only texts that have copies or near copies are looked up."""
    touched = found.filter("rows > 1 or node <> class_id").select(F.col("text_md5").alias("__md5"), F.col("node").alias("__node"), F.col("class_id").alias("__class"))
    joined = df.join(touched, F.md5(text) == F.col("__md5"), "left")
    own = F.coalesce(F.col(key).cast("long"), F.col("__node")) == F.col("__class")
    kept = joined.filter(F.col("__class").isNull() | (own & (F.col("__node") == F.col("__class"))))
    once = kept.filter(F.col("__class").isNotNull()).dropDuplicates(["__class"])
    return kept.filter(F.col("__class").isNull()).unionByName(once).select(*df.columns)
