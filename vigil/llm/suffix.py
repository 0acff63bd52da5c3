"""Suffix-array dedup: removes every byte covered by a string of LENGTH bytes that also starts earlier in the corpus.

Strings that are equal have the same least K-byte hash at the same place in them (leftmost, if it occurs again). So
the strings of a text fall into runs that share one such place; a run's segment is the bytes of its strings. Only
segments of one key (that hash) can have a string in common:

1. A pass over the texts gives a row for each run: key, hash of the segment, document, first string, strings. Keys
   that occur once are done with: most of the corpus ends here.
2. Of equal segments only the earliest keeps its strings; the others are covered. That settles copies and the inner
   parts of repeated passages, whatever their number, by sums that combine before the shuffle.
3. Keys with several different segments (a passage's edges) bring the earliest of each, with bytes, to one block.
   A block's suffixes are sorted, and threshold-bounded interval expansion on its Burrows-Wheeler transform finds the
   boundaries between suffixes with a common prefix below LENGTH, in breadth-first rounds of backward extension by
   increasing prefix length; it stops at LENGTH, and the rows that no boundary parts share a string.
4. Keys with more than HOT segments are cut into single strings, which are grouped by their bytes.

Texts are read as UTF-8 bytes, null as empty; documents are ordered by id, a null id first; rows that repeat both id
and text are one document and get the same result, rows that repeat an id alone are ordered by the text's SHA-256.
Tables without rows give none; other columns are kept. ``text`` of the result drops characters of which a byte is gone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import arrow_columns, cut_batch, numbered, offsets, ragged, texts_of, written

LENGTH, K = 100, 32
#: Bytes of a block whose suffixes are sorted together; a key's segments stay together, and keys above HOT have none here.
BLOCK_BYTES = 1_000_000
HOT = 4000
#: Texts are hashed in slices of this many bytes, which overlap so that no string is cut.
SLICE = 1 << 25
#: Texts hashed together: a dozen arrays of 64-bit numbers for each byte are held.
HASH_BYTES = 1_500_000
PLACE_BITS = 26
M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0x9E3779B97F4A7C15)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of twice the length from those of two halves."""
    x = left * M1 + right * M2
    x ^= x >> np.uint64(29)
    x *= M1
    return x ^ (x >> np.uint64(32))


def runs_of(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of strings of texts laid end to end (``ends``: of each text): key, segment hash, first string, strings."""
    nothing = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    if len(raw) < LENGTH:
        return nothing
    h = (raw.astype(np.uint64) + np.uint64(1)) * M1
    h, size = h ^ (h >> np.uint64(32)), 1
    while size < 2 * K:
        if size == K:
            key = h
        h, size = joined(h[:-size], h[size:]), 2 * size
    n = len(raw) - LENGTH + 1
    # the least hash of each string and its leftmost place: both in one number, minima by doubling
    low = (key >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(key), dtype=np.uint64)
    span, width = 1, LENGTH - K + 1
    while span * 2 <= width:
        low, span = np.minimum(low[:-span], low[span:]), span * 2
    if width > span:
        low = np.minimum(low[:n], low[width - span:width - span + n])
    place = (low & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    start = np.arange(n)
    text = np.searchsorted(ends, start, "right")
    valid = start + LENGTH <= ends[np.minimum(text, len(ends) - 1)]
    new = valid.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new)
    if not len(first):
        return nothing
    count = np.add.reduceat(valid.astype(np.int64), first)
    end = first + count - 1 + LENGTH  # a segment has at most 2 * LENGTH - K bytes: four hashes of 2 * K cover it
    part = joined(h[first], h[first + LENGTH - 2 * K])
    part = joined(part, joined(h[end - LENGTH], h[end - 2 * K]))
    return key[place[first]], joined(part, count.astype(np.uint64)), first, count


def bytes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raws = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raws), np.uint8), offsets(np.array([len(r) for r in raws], np.int64))


def text_runs(batches):
    """(doc, text) -> a row for each run: key, seg, doc, first, n."""
    for batch in batches:
        for part in cut_batch(batch, ["text"], HASH_BYTES):
            raw, at = bytes_of(texts_of(part.column(1)))
            doc = part.column(0).to_numpy(zero_copy_only=False)
            if not len(raw):
                continue
            found = []
            for lo in range(0, len(raw), SLICE):
                hi = min(lo + SLICE + LENGTH - 1, len(raw))
                ends = np.unique(np.clip(at[1:], lo, hi)) - lo
                key, seg, first, n = runs_of(raw[lo:hi], ends[ends > 0])
                found.append((key, seg, first + lo, n))
            key, seg, first, n = (np.concatenate(x) for x in zip(*found))
            owner = np.searchsorted(at[1:], first, "right")
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(seg.view(np.int64)), pa.array(doc[owner]), pa.array((first - at[owner]).astype(np.int32)), pa.array(n.astype(np.int32))],
                                             names=["key", "seg", "doc", "first", "n"])


def suffix_order(sym: np.ndarray) -> np.ndarray:
    """Order of the suffixes by their first 128 symbols: eight to begin with, then by doubling."""
    padded = np.concatenate([sym, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = padded[:len(sym)].copy()
    for k in range(1, 8):
        key = (key << np.uint64(8)) | padded[k:k + len(sym)]
    size = 8
    while True:
        order = np.argsort(key, kind="stable" if size > 64 else None)
        if size > LENGTH:
            return order
        sorted_key = key[order]
        rank = np.zeros(len(sym) + size, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])).astype(np.uint64)
        key = (rank[:len(sym)] << np.uint64(32)) | rank[size:]
        size *= 2


def boundaries(bwt: np.ndarray, limit: int) -> np.ndarray:
    """bounds[i]: the suffixes of the rows i - 1 and i have a common prefix below ``limit``.

    Breadth-first: the intervals of one round are those of the strings of one length whose right end was found in
    that round. Each is extended by every symbol before it; an extension whose right end is not known yet sets it
    and goes into the next round. Symbol 0 parts the texts and is never extended.
    """
    n = len(bwt)
    step = np.empty(n, np.int64)
    by_symbol = np.argsort(bwt, kind="stable")
    step[by_symbol] = np.arange(n)  # row of the suffix that is one symbol longer
    first_symbol = bwt[by_symbol]
    bounds = np.zeros(n + 1, bool)
    starts = np.searchsorted(first_symbol, np.arange(1, 258).astype(np.int64))
    lo, hi = starts[:-1], starts[1:] - 1
    bounds[starts] = True
    lo, hi = lo[lo <= hi], hi[lo <= hi]
    for _ in range(1, limit):
        if not len(lo):
            break
        size = hi - lo + 1
        rows = ragged(lo, size)
        owner = np.repeat(np.arange(len(lo)), size)
        real = bwt[rows] != 0
        both = np.sort((step[rows[real]] << 32) | owner[real])
        row, owner = both >> 32, both & 0xFFFFFFFF
        if not len(row):
            break
        symbol = first_symbol[row]
        new = np.concatenate([[True], (row[1:] != row[:-1] + 1) | (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])])
        lo = row[new]
        hi = row[np.append(np.flatnonzero(new)[1:] - 1, len(row) - 1)]
        fresh = ~bounds[hi + 1]
        lo, hi = lo[fresh], hi[fresh]
        bounds[hi + 1] = True
    return bounds


def repeated_strings(segs: list[bytes], doc: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the strings of LENGTH bytes in the segments, those that stand earlier in another place of the block: segment
    numbers and starts in the segment. Order: document, then place (``first``: of each segment in its document)."""
    lens = np.array([len(s) + 1 for s in segs], np.int64)
    sym = np.frombuffer(b"\0".join([s.translate(SHIFT) for s in segs]) + b"\0", np.uint8)
    order = suffix_order(sym)
    bounds = boundaries(sym[order - 1], LENGTH)
    group_of_row = np.cumsum(bounds[:-1])
    seg = np.repeat(np.arange(len(segs)), lens)[order]
    at = order - offsets(lens)[:-1][seg]
    whole = at + LENGTH < lens[seg]
    seg, at, group = seg[whole], at[whole], group_of_row[whole]
    if not len(seg):
        return seg, at
    place = (np.unique(doc, return_inverse=True)[1][seg] << 32) | (first[seg] + at)
    head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.repeat(np.minimum.reduceat(place, head), np.diff(np.append(head, len(group))))
    later = place > least
    return seg[later], at[later]


#: Symbols are bytes plus one, so that 0 is free; UTF-8 has no byte above 0xF4.
SHIFT = bytes(min(b + 1, 255) for b in range(256))


def intervals(start: np.ndarray, owner: np.ndarray, width: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merged byte ranges (owner, lo, hi) of strings given by their starts."""
    order = np.lexsort((start, owner))
    s, o = start[order], owner[order]
    if not len(s):
        return o, s, s
    new = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (s[1:] > s[:-1] + width)]))
    return o[new], s[new], s[np.append(new[1:] - 1, len(s) - 1)] + width


def expand_blocks(batches):
    """Rows (key, doc, first, bytes), sorted by key: covered ranges (doc, lo, hi), block by block of whole keys."""
    held: list = []
    size = 0

    def flush():
        doc, first = np.array([x[1] for x in held], np.int64), np.array([x[2] for x in held], np.int64)
        seg, at = repeated_strings([x[3] for x in held], doc, first)
        o, lo, hi = intervals(first[seg] + at, seg)
        return pa.RecordBatch.from_arrays([pa.array(doc[o]), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["doc", "lo", "hi"])

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if size >= BLOCK_BYTES and row[0] != held[-1][0]:
                yield flush()
                held, size = [], 0
            held.append(row)
            size += len(row[3])
    if held:
        yield flush()


def cut_segments(batches):
    """(doc, text, wanted) -> bytes of the wanted segments; of hot keys, each string by itself, keyed by a hash of its bytes."""
    for batch in batches:
        out: list = []
        for doc, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(3))):
            raw = (text or "").encode()
            for x in wanted:
                seg = raw[x["first"]:x["first"] + x["n"] - 1 + LENGTH]
                if x["hot"]:
                    out += [(None, doc, x["first"] + i, seg[i:i + LENGTH]) for i in range(x["n"])]
                else:
                    out.append((x["key"], doc, x["first"], seg))
            if len(out) > 20000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=["key", "doc", "first", "bytes"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=["key", "doc", "first", "bytes"])


def covered(base: DataFrame, text: str) -> DataFrame:
    """Byte ranges (doc, lo, hi) of ``base`` (column doc: a distinct long) that strings standing earlier cover."""
    runs = base.select("doc", F.col(text).alias("text")).mapInArrow(text_runs, "key long, seg long, doc long, first int, n int")
    keys = runs.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("seg").alias("s0"), F.max("seg").alias("s1")).filter("rows > 1")
    # written, so that the join has a shuffle of its own on both sides and can split the rows of a hot key
    keys = written(keys.select("key", (F.col("s0") != F.col("s1")).alias("mixed")))
    shared = written(runs.join(keys, "key"))

    heads = written(shared.groupBy("key", "seg").agg(F.min(F.struct("doc", "first")).alias("head"), F.any_value("n").alias("n"), F.any_value("mixed").alias("mixed")))
    again = (shared.join(heads.select("key", "seg", "head"), ["key", "seg"]).filter((F.col("doc") != F.col("head.doc")) | (F.col("first") != F.col("head.first")))
             .select("doc", F.col("first").alias("lo"), (F.col("first") + F.col("n") - 1 + LENGTH).alias("hi")))

    edges = heads.filter("mixed").select("key", "head.doc", "head.first", "n")
    hot = edges.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > HOT).select("key", F.lit(True).alias("hot"))
    edges = edges.join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = edges.groupBy("doc").agg(F.collect_list(F.struct("key", "first", "n", "hot")).alias("wanted"))
    # all columns go along, so that the shuffle of the texts is the one that the removal needs too
    segments = base.join(wanted, "doc").select("doc", text, "wanted", *[c for c in base.columns if c not in ("doc", text)]).mapInArrow(cut_segments, "key long, doc long, first int, bytes binary")
    in_blocks = (segments.filter("key is not null").repartition("key").sortWithinPartitions("key", "doc", "first")
                 .mapInArrow(expand_blocks, "doc long, lo int, hi int"))
    single = segments.filter("key is null").drop("key")
    least = single.groupBy("bytes").agg(F.min(F.struct("doc", "first")).alias("head"))
    alone = (single.join(least, "bytes").filter((F.col("doc") != F.col("head.doc")) | (F.col("first") != F.col("head.first")))
             .select("doc", F.col("first").alias("lo"), (F.col("first") + LENGTH).alias("hi")))
    return again.unionByName(in_blocks).unionByName(alone)


def remove(raw: bytes, spans: list) -> tuple[list[tuple[int, int]], bytes]:
    """Merged spans (touching ones are one run) and the bytes that are left."""
    runs: list = []
    for lo, hi in sorted(spans):
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi)
        else:
            runs.append([lo, hi])
    left, end = [], 0
    for lo, hi in runs:
        left.append(raw[end:lo])
        end = hi
    return [tuple(r) for r in runs], b"".join([*left, raw[end:]])


def distinct_ids(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` with ``doc``, a long that orders the documents: the id itself where ids are whole and distinct (which is
    counted), else the place among the distinct (id, text)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col(key).isNull() | (F.col("n") > 1)).limit(1).count()
    if not counts and dict(df.dtypes)[key] in ("bigint", "int"):
        return df.withColumn("doc", F.col(key).cast("long"))
    sha = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    ids = numbered(df.select(F.col(key).alias("__key"), sha.alias("__sha")).distinct(), [F.col("__key"), F.col("__sha")])
    ids = written(ids.select("__key", "__sha", F.col("rank").cast("long").alias("doc")))
    return df.join(ids, F.col(key).eqNullSafe(F.col("__key")) & (sha == F.col("__sha"))).drop("__key", "__sha")


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<lo:int,hi:int>>"


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """``df`` with what is left of ``text`` (dropped, if not ``with_text``), n_bytes, n_removed, n_spans, kept_sha256 and spans."""
    own = [c for c in df.columns if c not in ("doc", "__spans", *T.StructType.fromDDL(RESULT).fieldNames())]
    # no id is null here; said so, both joins read the texts through the same filter and share one shuffle of them
    base = distinct_ids(df.select(*own), key, text).filter(F.col("doc").isNotNull())
    spans = covered(base, text).groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("__spans"))

    def make():
        def run(texts, spans):
            n_bytes, n_removed, found, shas, left_text = [], [], [], [], []
            for t, s in zip(texts_of(texts), spans.to_pylist()):
                raw = t.encode()
                runs, left = remove(raw, [(x["lo"], x["hi"]) for x in s or []])
                n_bytes.append(len(raw))
                n_removed.append(len(raw) - len(left))
                found.append([{"lo": a, "hi": b} for a, b in runs])
                shas.append(hashlib.sha256(left).hexdigest())
                left_text.append(left.decode("utf-8", "ignore") if runs else t)
            out = [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array([len(f) for f in found], pa.int64()), pa.array(shas, pa.string()),
                   pa.array(found, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))]
            return [pa.array(left_text, pa.string()), *out] if with_text else out

        return run

    fields = T.StructType(([T.StructField(text, T.StringType())] if with_text else []) + list(T.StructType.fromDDL(RESULT)))
    done = arrow_columns(base.join(spans, "doc", "left"), [text, "__spans"], fields, make).drop("doc", "__spans")
    return done if with_text else done.drop(text)
