"""Quality rules: word statistics of whole texts, thresholds from mergeable quantile sketches, joined filtering.

``text_stats`` counts words, symbols, repeated lines and repeated 3-word windows of each text. ``sketch`` summarises
the rates made of them per group (language and source) as logarithmic histograms: a bucket holds the values within
one relative step, so sketches merge by adding counts, in any order, with the same result. ``thresholds`` reads an
upper fence for each rate and group off the sketches; groups with few rows take the merged sketch of their language,
languages with few rows that of the whole table. ``verdict`` joins the fences back and filters.

Null and empty texts have no words and fail the base rule. Null languages and sources are groups of their own.
Ties don't matter (counts only); repeated rows are counted and judged one by one; a table without rows gives none.
A column of the input with the name of an output is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import Vocabulary, arrow_columns, texts_of, written

SYMBOLS = b"#*$%&|<>"
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
WINDOW = 3
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
#: Base rule: fewer words, or a larger share of words in repeated windows, fail in any language and source.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Relative width of a sketch's bucket; quantiles are right to about half of it.
STEP = 0.02
#: Rows that a group needs for fences of its own.
MIN_GROUP_ROWS = 200
#: Fence: a high quantile, plus REACH times its distance from the median, plus a slack near the sketch's resolution.
REACH = 3.0
#: Rates judged: the quantile that their fence starts from (repetition has a long tail in good text, so it starts further out), and the slack.
RATES = {"symbol_rate": (0.9, 0.01), "dup_line_rate": (0.99, 0.02), "repeat_rate": (0.99, 0.02), "upper_rate": (0.9, 0.01), "chars_per_word": (0.9, 0.1)}


def repeat_words(words: np.ndarray, kinds: int) -> int:
    """Words that lie in a window of WINDOW words which occurs twice or more (all occurrences count)."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    if kinds < 2_000_000:
        key = (words[:-2] * kinds + words[1:-1]) * kinds + words[2:]
    else:  # the product would not fit: number the pairs first
        _, pair = np.unique(words[:-1] * kinds + words[1:], return_inverse=True)
        key = pair[:-1] * kinds + words[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(n, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    hit = np.zeros(len(words), bool)
    for k in range(WINDOW):
        hit[k:k + n] |= again
    return int(hit.sum())


def stats_of(text: str) -> tuple[int, ...]:
    raw = text.encode()
    words = raw.split()  # on bytes this cuts at exactly the six ASCII white-space characters
    number = Vocabulary()
    ids = np.array([number[w] for w in words], np.int64)
    seen, dup, lines = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            dup += line in seen
            seen.add(line)
    chars = len(text) - (len(raw) - len(raw.translate(None, WHITE)))
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), dup, repeat_words(ids, len(number)), lines, upper


def text_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts STATS of each whole text."""
    def run(col):
        rows = [stats_of(t) for t in texts_of(col)]
        return [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(STATS))]

    return arrow_columns(df, [text], T.StructType([T.StructField(c, T.LongType()) for c in STATS]), lambda: run)


def with_rates(stats: DataFrame) -> DataFrame:
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return stats.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        "symbol_rate": share("n_symbols", "word_chars"), "dup_line_rate": share("n_dup_lines", "n_lines"),
        "repeat_rate": share("n_repeat_words", "n_words"), "upper_rate": share("n_upper", "word_chars"),
        "chars_per_word": share("word_chars", "n_words")})


def sketch(rated: DataFrame, by: list[str]) -> DataFrame:
    """Counts by group, rate and bucket of the rows that pass the base rule: one row for each bucket that occurs."""
    pairs = F.explode(F.create_map(*[x for r in RATES for x in (F.lit(r), F.col(r))])).alias("rate", "value")
    bucket = F.when(F.col("value") > 0, F.ceil(F.log(F.col("value")) / np.log1p(STEP))).alias("bucket")
    return (rated.filter(~F.col("base_failed")).select(*by, pairs).select(*by, "rate", bucket)
            .groupBy(*by, "rate", "bucket").agg(F.count(F.lit(1)).alias("n")))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of larger groups, by adding up counts."""
    return sketches.groupBy(*by, "rate", "bucket").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Per group and rate: rows, and the upper fence from the median and the high quantile of its sketch. A quantile is the upper
    edge of its bucket, so rows that are all alike are never above their fence."""
    group = Window.partitionBy(*by, "rate")
    value = F.coalesce(F.pow(F.lit(1 + STEP), F.col("bucket").cast("double")), F.lit(0.0))
    cum = sketches.select("*", F.sum("n").over(group.orderBy(F.col("bucket").asc_nulls_first())).alias("cum"),
                          F.sum("n").over(group).alias("rows"), value.alias("value"))
    at = lambda q: F.min(F.when(F.col("cum") >= q * F.col("rows"), F.col("value")))
    of_rate = lambda i: F.coalesce(*[F.when(F.col("rate") == r, F.lit(x[i])) for r, x in RATES.items()])
    slack = of_rate(1)
    return (cum.groupBy(*by, "rate").agg(F.max("rows").alias("rows"), at(0.5).alias("mid"), at(of_rate(0)).alias("high"))
            .select(*by, "rate", "rows", (F.col("high") + REACH * (F.col("high") - F.col("mid")) + slack).alias("fence")))


def pivoted(f: DataFrame, by: list[str], tag: str) -> DataFrame:
    return f.groupBy(*by).agg(F.max("rows").alias(f"{tag}_rows"), *[F.max(F.when(F.col("rate") == r, F.col("fence"))).alias(f"{tag}_{r}") for r in RATES])


def thresholds(rated: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per (language, source) met: a fence for each rate, from the smallest group with enough rows."""
    own = sketch(rated, [lang, source])
    by_lang = merged(own, [lang])
    a = pivoted(fences(own, [lang, source]), [lang, source], "own")
    b = pivoted(fences(by_lang, [lang]), [lang], "lang").withColumnRenamed(lang, "__lang")
    everything = merged(by_lang.withColumn("__all", F.lit(0)), ["__all"])
    whole = {r["rate"]: r["fence"] for r in fences(everything, ["__all"]).collect()}  # a row for each rate
    joined = a.join(b, F.col(lang).eqNullSafe(F.col("__lang")), "left")
    pick = lambda r: F.when(F.col("own_rows") >= MIN_GROUP_ROWS, F.col(f"own_{r}")).when(F.col("lang_rows") >= MIN_GROUP_ROWS, F.col(f"lang_{r}")).otherwise(F.lit(whole.get(r)).cast("double"))
    return joined.select(F.col(lang).alias("__lang"), F.col(source).alias("__source"), *[pick(r).alias(f"{r}_fence") for r in RATES])


def verdict(stats: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``stats`` with base_failed, the rates, their fences, and ``kept``: passes the base rule and is above no fence."""
    rated = with_rates(stats)
    t = thresholds(rated, lang, source)
    joined = rated.join(t, F.col(lang).eqNullSafe(F.col("__lang")) & F.col(source).eqNullSafe(F.col("__source")), "left")
    above = [F.coalesce(F.col(r) > F.col(f"{r}_fence"), F.lit(False)) for r in RATES]
    return joined.drop("__lang", "__source").withColumn("kept", ~F.col("base_failed") & ~F.array_contains(F.array(*above), True))


def filtered(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``df`` that are kept. The counts are taken once and written beside the texts, since the fences
    need them of all rows first; the fences, a row for each group, are then joined to the rows."""
    names = [f"__c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    place = lambda c: names[df.columns.index(c)]
    judged = verdict(written(text_stats(plain, place(text))), place(lang), place(source))
    return judged.filter("kept").select(*names).toDF(*df.columns)
