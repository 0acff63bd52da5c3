"""Source divergence audit: which terms, and which other sources, set a source apart from its language.

The terms of a language that are met in at least ``min_docs`` of its documents are found by iceberg prefix refinement: the
distinct documents of each term prefix are counted, prefixes below the threshold are discarded, those left are extended by
the next bytes, and so on until only complete terms remain (prefixes of 4, 8, 16, ... bytes). No term in ``min_docs``
documents has a prefix in fewer, so the result is that of counting every term, but the long tail of rare terms never
meets in the count by source. The texts are cut into terms once: each task writes, for slices of its documents, the
documents of each (language, prefix) and the documents and occurrences of each (language, source, term); a document lies
whole in one slice, so sums over slices are exact. Each level then reads only its own rows of that table and joins them
to the prefixes that the level before has left.

Terms are runs of letters A-Z and of characters beyond ASCII, with A-Z in lower case. A row of the table is a document.
A null text, language or source counts as the empty one; columns but these three are left out, so their names never
clash. Arithmetic is exact: whole numbers, decimals where a product could pass 64 bits. A table without rows gives no rows.
Ties rank by the item's bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import cut_batch, written

#: Everything that no term holds.
GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS, TOP, FIRST_LEVEL = 10, 10, 4
SCALE = 1_000_000_000
#: Bytes of text whose terms are summed at once.
SLICE_BYTES = 16_000_000
#: The table of (language, source) groups is broadcast up to so many rows; a larger one is joined by a shuffle.
BROADCAST_GROUPS = 200_000
#: Sources compared at once in one matrix, about so many (source, term) counts to a group, and the cells of one step's array.
BLOCK, GROUP_ROWS, STEP_CELLS = 64, 100_000, 4_000_000
#: level 0: a whole term of one source; else the bytes of the prefix, of all sources (source is null), of the terms longer than the
#: level; the first level has all terms, short ones as they are.
SUMS = T.StructType([T.StructField("level", T.IntegerType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("term", T.BinaryType()), T.StructField("docs", T.LongType()), T.StructField("n", T.LongType())])


def terms_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For the texts of a column: the row and the term number of each term in them, and the terms as bytes."""
    own = col.take(pa.array(np.arange(len(col))))  # a copy: on slices of a batch, Arrow's ascii_lower can read beside the texts
    bare = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(own, "")), GAP, " ")
    lists = pc.split_pattern(bare, " ")
    flat = pc.dictionary_encode(lists.flatten())
    rows = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    code, names = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.dictionary.cast(pa.binary())
    blank = pc.index(names, pa.scalar(b"", pa.binary())).as_py()
    if blank >= 0:
        there = code != blank
        rows, code = rows[there], code[there]
    return rows, code, names


def _codes(col: pa.Array) -> tuple[np.ndarray, pa.Array]:
    x = pc.dictionary_encode(col)
    return x.indices.to_numpy(zero_copy_only=False).astype(np.int64), x.dictionary


def slice_sums(docs: DataFrame) -> DataFrame:
    """SUMS over slices of the documents (text, lang, source)."""
    def batch_of(level, lang, source, term, n_docs, n):
        size = len(n_docs)
        return pa.RecordBatch.from_arrays([pa.array(np.full(size, level), pa.int32()), lang, pa.nulls(size, pa.string()) if source is None else source, term,
                                           pa.array(n_docs, pa.int64()), pa.array(n, pa.int64())], names=SUMS.fieldNames())

    def run(batches):
        for batch in batches:
            for part in cut_batch(batch, ["text"], SLICE_BYTES):
                text, lang, source = (part.column(part.schema.get_field_index(c)) for c in ("text", "lang", "source"))
                rows, code, names = terms_of(text)
                if not len(code):
                    continue
                lang_of, langs = _codes(lang)
                source_of, sources = _codes(source)
                group_of, groups = lang_of * len(sources) + source_of, len(langs) * len(sources)
                size = len(names)
                # distinct terms of each document, then of each group
                pairs, times = np.unique(rows * size + code, return_counts=True)
                row, code = pairs // size, pairs % size
                key, at, docs_in = np.unique(group_of[row] * size + code, return_inverse=True, return_counts=True)
                n = np.bincount(at, times, len(key)).astype(np.int64)
                g, c = key // size, key % size
                assert groups > g.max()
                yield batch_of(0, langs.take(pa.array(g // len(sources))), sources.take(pa.array(g % len(sources))), names.take(pa.array(c)), docs_in, n)
                length, level = pc.binary_length(names).to_numpy(zero_copy_only=False), FIRST_LEVEL
                while len(code):
                    begins = np.unique(code)
                    number, prefixes = _codes(pc.binary_slice(names.take(pa.array(begins)), 0, level))
                    prefix_of = np.zeros(size, np.int64)
                    prefix_of[begins] = number
                    met = np.unique(row * len(prefixes) + prefix_of[code])
                    key, docs_in = np.unique(lang_of[met // len(prefixes)] * len(prefixes) + met % len(prefixes), return_counts=True)
                    yield batch_of(level, langs.take(pa.array(key // len(prefixes))), None, prefixes.take(pa.array(key % len(prefixes))), docs_in, np.zeros(len(key), np.int64))
                    level *= 2
                    longer = length[code] > level
                    row, code = row[longer], code[longer]

    return docs.select("text", "lang", "source").mapInArrow(run, SUMS)


def refined(sums: DataFrame, min_docs: int) -> DataFrame | None:
    """(lang, prefix) of every prefix, of any level, that ``min_docs`` documents and no discarded prefix hold; None: there is no term."""
    levels = sorted(r["level"] for r in sums.select("level").distinct().collect() if r["level"])  # doubling lengths: a few dozen at most
    left = None
    for level in levels:
        rows = sums.filter(F.col("level") == level).select("lang", F.col("term").alias("prefix"), "docs")
        if level > FIRST_LEVEL:
            before = left.filter(F.octet_length("prefix") == level // 2).withColumnRenamed("prefix", "head")
            rows = rows.withColumn("head", F.substring("prefix", 1, level // 2)).join(before, ["lang", "head"], "left_semi")
        found = written(rows.groupBy("lang", "prefix").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).select("lang", "prefix"))
        left = found if left is None else left.unionByName(found)
    return left


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n): occurrences by source of the terms met in ``min_docs`` documents of their language; terms as bytes."""
    sums = written(slice_sums(docs), partition_by="level", compression="zstd")
    left = refined(sums, min_docs)
    whole = sums.filter("level = 0").select("lang", "source", "term", "docs", "n")
    if left is not None:
        # the longest level below the term's length, or the first level
        size = F.octet_length("term")
        power = F.greatest(F.floor(F.log2(F.greatest(size - 1, F.lit(1)) / FIRST_LEVEL) + 1e-9), F.lit(0))
        whole = whole.withColumn("prefix", F.substring(F.col("term"), F.lit(1), (FIRST_LEVEL * F.pow(F.lit(2), power)).cast("int"))).join(left, ["lang", "prefix"], "left_semi").drop("prefix")
    by_source = written(whole.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")))
    kept = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).select("lang", "term")
    return by_source.drop("docs").join(kept, ["lang", "term"], "left_semi")


def share(n: Column, total: Column, kept: Column) -> Column:
    """p = 1 + floor(SCALE * (n + 2) / (total + 2 * kept)), exact."""
    wide = "decimal(38,0)"
    return (F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)"), (total + 2 * kept).cast(wide))).cast("long")


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); p and q are at most SCALE + 1, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def pair_sums(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, seen, value): for source numbers a < b, f summed over the terms of one group of terms that a block of sources has.

    ``counts`` has lang, term, s (number of the source in its language), p; ``groups`` lang, s, zero (p of a count of 0); both the language's top (last block) and salt_n.
    Each count meets its block of sources once for each other block, never each other source."""
    schema = T.StructType([T.StructField("lang", T.StringType())] + [T.StructField(n, T.LongType()) for n in ("i", "j", "a", "b", "seen", "value")])

    def run(key, table):
        i, j = key[1].as_py(), key[2].as_py()
        kind, s, p = (table.column(c).to_numpy() for c in ("kind", "s", "p"))
        zero_at, zero = s[kind == 0], p[kind == 0]
        left, right = np.sort(zero_at[zero_at // BLOCK == i]), np.sort(zero_at[zero_at // BLOCK == j])
        base = dict(zip(zero_at.tolist(), zero.tolist()))
        term = pc.dictionary_encode(table.column("term").combine_chunks().filter(pa.array(kind == 1))).indices.to_numpy()
        s, p = s[kind == 1], p[kind == 1]
        m = int(term.max()) + 1 if len(term) else 0
        total = np.zeros((len(left), len(right)), np.int64)
        step = max(1, STEP_CELLS // max(1, len(left) * len(right)))
        order = np.argsort(term, kind="stable")
        term, s, p = term[order], s[order], p[order]
        for lo in range(0, m, step):
            hi = min(m, lo + step)
            cut = slice(np.searchsorted(term, lo), np.searchsorted(term, hi))
            sides = []
            for ids in (left, right):
                x = np.repeat(np.array([base[v] for v in ids.tolist()], np.int64)[None, :], hi - lo, 0)
                at = np.searchsorted(ids, s[cut])
                own = (at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == s[cut])
                x[term[cut][own] - lo, at[own]] = p[cut][own]
                sides.append(x)
            a, b = sides[0][:, :, None], sides[1][:, None, :]
            total += ((a - b) ** 2 // (a + b)).sum(0)
        x, y = np.meshgrid(left, right, indexing="ij")
        there = x < y
        out = [pa.array([key[0].as_py()] * int(there.sum()), pa.string())]
        out += [pa.array(v, pa.int64()) for v in (np.full(there.sum(), i), np.full(there.sum(), j), x[there], y[there], np.full(there.sum(), m), total[there])]
        return pa.table(out, names=schema.fieldNames())

    # block pairs (i, j), i <= j, that hold a block
    mine = F.expr(f"transform(sequence(0L, top), z -> struct(least(z, floor(s / {BLOCK})) AS i, greatest(z, floor(s / {BLOCK})) AS j))")
    body = counts.withColumn("salt", F.pmod(F.xxhash64("term"), F.col("salt_n")))
    body = body.select("lang", F.explode(mine).alias("ij"), "salt", F.lit(1).alias("kind"), "s", "p", "term")
    head = groups.withColumn("salt", F.explode(F.expr("sequence(0L, salt_n - 1)")))
    head = head.select("lang", F.explode(mine).alias("ij"), "salt", F.lit(0).alias("kind"), "s", F.col("zero").alias("p"), F.lit(None).cast("binary").alias("term"))
    both = body.unionByName(head).select("lang", "ij.i", "ij.j", "salt", "kind", "s", "p", "term")
    return both.groupBy("lang", "i", "j", "salt").applyInArrow(run, schema).groupBy("lang", "a", "b").agg(F.sum("seen").alias("seen"), F.sum("value").alias("value"))


def audit(df: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: for each (lang, source), every other source by distance, and the ``top`` terms above the language."""
    docs = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counts = written(term_counts(docs, min_docs))
    kept = counts.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    groups = docs.select("lang", "source").distinct().join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("met")), ["lang", "source"], "left")
    groups = groups.join(kept, "lang", "left").na.fill(0, ["total", "met", "kept"])
    of_lang = Window.partitionBy("lang")  # a row for each source: as many as the report has for each of them
    groups = groups.select("*", (F.row_number().over(of_lang.orderBy("source")) - 1).cast("long").alias("s"), F.sum("total").over(of_lang).alias("all_total"),
                           (F.floor((F.count(F.lit(1)).over(of_lang) - 1) / BLOCK)).cast("long").alias("top"), (F.floor(F.sum("met").over(of_lang) / GROUP_ROWS) + 1).cast("long").alias("salt_n"))
    groups = written(groups.withColumn("zero", F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))).otherwise(1)))
    shown = F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups
    shares = written(counts.join(shown, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept"))))

    sums = pair_sums(shares, groups)
    facts = groups.select("lang", "s", "source", "zero", "kept")
    a = facts.select("lang", F.col("s").alias("a"), F.col("source").alias("a_source"), F.col("zero").alias("a_zero"), "kept")
    b = facts.select("lang", F.col("s").alias("b"), F.col("source").alias("b_source"), F.col("zero").alias("b_zero"))
    # the terms that neither block has differ by the distance of two empty counts
    rest = (F.col("kept") - F.col("seen")) * distance(F.col("a_zero"), F.col("b_zero"))
    both = sums.join(a, ["lang", "a"]).join(b, ["lang", "b"]).select("lang", "a_source", "b_source", (F.col("value") + rest).alias("value"))
    pair = both.select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), "value").unionByName(
        both.select("lang", F.col("b_source").alias("source"), F.col("a_source").alias("item"), "value")).withColumn("part", F.lit("pair"))

    q = shares.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.max("all_total").alias("all_total"), F.max("kept").alias("kept"))
    q = q.select("lang", "term", share(F.col("all_n"), F.col("all_total"), F.col("kept")).alias("q"))
    term = shares.select("lang", "source", "term", "p").join(q, ["lang", "term"]).filter("p > q").select(
        "lang", "source", F.col("term").cast("string").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = term.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
    out = ["lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank"]
    return pair.withColumn("rank", F.row_number().over(by)).select(*out).unionByName(term.select(*out))
