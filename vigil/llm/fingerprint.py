"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections of a text, in DataFrame functions.

A section ends at a blank line, a paragraph at a line end; a piece is a sentence, or PIECE characters of a longer one.
A node's digest is the SHA-256 of its children's digests, so equal roots mean equal trees, and two trees differ only
below nodes that differ. ``fingerprint`` writes the tree as text: the root, a colon, then the first 8 hex digits of each
piece's digest, with "." between pieces, "," between paragraphs, ";" between sections. ``likeness`` compares two of them,
``differing`` lists the paragraphs in which they differ.

``with_next`` brings each document together with the start of the next one (ascending id, after the last the first).
Null texts count as empty; the empty text has one empty piece. A null id counts as smaller than all others; of rows
with one id, the next document of the id before is the row whose text has the smallest hash. A single document is its
own next one. Tables without rows give none; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import numbered, written

PIECE = 80
PIECES = f"[^.!?]{{1,{PIECE}}}[.!?]*\\s*|[.!?]+\\s*"
NULL_ID = -(2**63)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fingerprint(text: Column) -> Column:
    """The tree of a text, as described above."""
    digest = lambda x: F.sha2(x, 256)

    def node(children):  # of structs (digest, written form): one struct
        return lambda sep: let(children, lambda xs: F.struct(digest(F.array_join(F.transform(xs, lambda x: x["d"]), "")).alias("d"),
                                                             F.array_join(F.transform(xs, lambda x: x["s"]), sep).alias("s")))

    def piece(p):
        return let(digest(p), lambda d: F.struct(d.alias("d"), F.substring(d, 1, 8).alias("s")))

    def paragraph(line):
        pieces = F.regexp_extract_all(line, F.lit(f"({PIECES})"))
        return node(F.transform(F.when(line == "", F.array(line)).otherwise(pieces), piece))(".")

    def section(part):
        return node(F.transform(F.split(part, "\n"), paragraph))(",")

    sections = F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n"), section)
    return let(node(sections)(";"), lambda root: F.concat(root["d"], F.lit(":"), root["s"]))


def leaves(print_: Column) -> Column:
    return F.array_distinct(F.split(F.substring_index(print_, ":", -1), "[.,;]"))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else the common pieces of two fingerprints in parts of the larger one's pieces."""
    common = let(F.struct(leaves(a).alias("a"), leaves(b).alias("b")),
                 lambda x: F.size(F.array_intersect(x["a"], x["b"])) / F.greatest(F.size(x["a"]), F.size(x["b"])))
    return F.when(a == b, 1.0).otherwise(common)


def differing(a: Column, b: Column) -> Column:
    """The paragraphs in which two trees differ, as structs (section, paragraph), from 0; equal sections are not looked into."""
    unlike = lambda x, y: F.filter(F.sequence(F.lit(0), F.greatest(F.size(x), F.size(y)) - 1), lambda i: ~F.get(x, i).eqNullSafe(F.get(y, i)))

    def inside(x, y, s):
        parts = F.struct(F.split(F.coalesce(F.get(x, s), F.lit("")), ",").alias("x"), F.split(F.coalesce(F.get(y, s), F.lit("")), ",").alias("y"))
        return let(parts, lambda p: F.transform(unlike(p["x"], p["y"]), lambda i: F.struct(s.alias("section"), i.alias("paragraph"))))

    tree = lambda p: F.split(F.substring_index(p, ":", -1), ";")
    both = F.struct(tree(a).alias("a"), tree(b).alias("b"))
    return let(both, lambda t: F.flatten(F.transform(unlike(t["a"], t["b"]), lambda s: inside(t["a"], t["b"], s))))


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text", part: int = 4) -> DataFrame:
    """key, text, fingerprint of each row, and of the next document its fingerprint and as many first code points
    as the row's own text has, divided by ``part`` (next_fingerprint, next_start).

    The order is made of ids alone. Texts are shuffled once by id; the starts of texts, a part of them, once more
    by the id before.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("__key"), body.alias("__text"))
    ids = rows.groupBy("__key").agg(F.max(F.floor(F.length("__text") / part)).cast("int").alias("__len"))
    ranked = written(numbered(ids, [F.col("__key")]))
    n = ranked.count()
    before = ranked.select(F.col("__key").alias("__prev"), F.col("__len").alias("__prev_len"), ((F.col("rank") + 1) % max(n, 1)).alias("rank"))
    follows = before.join(ranked.select("__key", "rank"), "rank").drop("rank")

    own = rows.withColumn("__print", fingerprint(F.col("__text"))).repartition("__key")
    starts = own.join(follows, "__key").select("__prev", F.col("__print").alias("next_fingerprint"), F.xxhash64("__text").alias("__hash"),
                                               F.substring(F.col("__text"), F.lit(1), F.col("__prev_len")).alias("next_start"))
    first = F.row_number().over(Window.partitionBy("__prev").orderBy("__hash"))
    starts = starts.withColumn("__nth", first).filter("__nth = 1").drop("__nth", "__hash")
    return own.join(starts, F.col("__key") == F.col("__prev")).select(
        F.when(F.col("__key") != NULL_ID, F.col("__key")).alias(key), F.col("__text").alias(text), F.col("__print").alias("fingerprint"), "next_fingerprint", "next_start")
