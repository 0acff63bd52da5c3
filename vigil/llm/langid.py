"""Language identification of mixed-language text: script ranges, word scores, and Viterbi with a switching penalty.

``train`` counts the letter sequences of words per language. A word's score for a language is the log probability of
its sequences; a language is a candidate for a word only if the word's script holds at least MIN_SCRIPT of the letters
that the language was learned from. ``label`` runs Viterbi over the words of each whole text, where a change of
language costs PENALTY, and gives the spans; the text's language is the one with most letters (ties: the first by code point).

Trained on at most about MAX_TRAIN_DOCS labelled texts, of each language the ones with the smallest hashes of their ids:
rare languages give all their texts, the others alike many, and each at least one. The scores come from text alone. Null texts and texts without a letter have no span: "und", score 0. Words of a script that no
language was learned from count for all alike. Repeated rows are labelled one by one; a table without rows gives none.
Without any training row every text is "und".
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import chains
from vigil.llm.common import Vocabulary, arrow_columns, held_out, offsets, texts_of

MAX_TRAIN_DOCS = 20_000
PENALTY = 6.0
MIN_SCRIPT = 0.01
CACHE_WORDS = 600_000
GRAM = 3
#: First code points of script ranges, in order; a letter has the script of the last start at or below it.
SCRIPTS = [(0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x700, "other"), (0x750, "arabic"), (0x780, "other"),
           (0x900, "devanagari"), (0x980, "bengali"), (0xA00, "indic"), (0xE00, "thai"), (0xE80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
           (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han")]
STARTS, SCRIPT_OF = np.array([s for s, _ in SCRIPTS]), [n for _, n in SCRIPTS]
WORDS = re.compile(r"[^\W\d_]+").findall
SPANS = "array<struct<first_word:int,last_word:int,lang:string>>"


def script(word: str) -> str:
    return SCRIPT_OF[int(np.searchsorted(STARTS, ord(word[0]), "right")) - 1]


def grams(word: str) -> list[str]:
    """The sequences of GRAM letters of a word with its ends marked, and the word itself."""
    w = f"^{word}$"
    return [w[i:i + GRAM] for i in range(len(w) - GRAM + 1)] + [w]


def even_share(counts: list[int], total: int) -> float:
    """The most that each language may give, so that all of them together give ``total`` at most (one each at least)."""
    for k, n in enumerate(sorted(counts)):
        share = total / (len(counts) - k)
        if n > share:
            return max(share, 1.0)
        total -= n
    return float(max(counts, default=0))


def train(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", max_docs: int = MAX_TRAIN_DOCS) -> dict:
    """Counts per language of sequences and scripts, added up over the tasks; the tables are bounded by ``max_docs``."""
    rows = df.filter(~held_out(key) & F.col(lang).isNotNull())
    h = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(1 << 30))
    found = rows.groupBy(F.col(lang).alias("__lang")).agg(F.count(F.lit(1)).alias("n"), F.min(h).alias("least")).collect()  # a row for each language, no text is read
    most = even_share([r["n"] for r in found], max_docs)
    limits = [(r["__lang"], max(int(min(1.0, most / r["n"]) * (1 << 30)), r["least"] + 1)) for r in found]
    limits = df.sparkSession.createDataFrame(limits, "__lang string, __limit long")
    rows = rows.join(F.broadcast(limits), F.col(lang) == F.col("__lang")).filter(h < F.col("__limit"))

    def count(batches):
        seen: dict = {}
        for b in batches:
            for t, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = seen.setdefault(name, {})
                for w in WORDS((t or "").lower()):
                    words[w] = words.get(w, 0) + 1
        for name, words in seen.items():
            table: dict = {}
            for w, k in words.items():
                for g in grams(w):
                    table[g] = table.get(g, 0) + k
                table["script " + script(w)] = table.get("script " + script(w), 0) + k * len(w)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(table), pa.string()), pa.array(list(table), pa.string()), pa.array(list(table.values()), pa.int64())], names=["lang", "gram", "n"])

    counts = rows.select(text, lang).mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # a whole word met once says no more than its parts
    got = counts.filter((F.length("gram") <= GRAM) | F.col("gram").startswith("script ") | (F.col("n") >= 5)).toPandas()
    return model_of(got)


def model_of(counts) -> dict:
    langs = sorted(counts["lang"].unique())
    is_script = counts["gram"].str.startswith("script ")
    scripts = counts[is_script].assign(script=lambda x: x["gram"].str[7:])
    share = scripts.pivot_table(index="script", columns="lang", values="n", aggfunc="sum", fill_value=0).reindex(columns=langs, fill_value=0)
    share = share / share.sum(axis=0).clip(lower=1)
    table = counts[~is_script].pivot_table(index="gram", columns="lang", values="n", aggfunc="sum", fill_value=0).reindex(columns=langs, fill_value=0)
    n = table.to_numpy(np.float64)
    # smoothed by the gram's mean over the languages: a gram that is equally frequent in all says nothing
    rate = n / np.maximum(n.sum(axis=0), 1)
    mean = rate.mean(axis=1, keepdims=True) if len(langs) else rate
    smooth = np.log(rate + 0.05 * mean + 1e-9) - np.log(mean * 1.05 + 1e-9) if len(langs) else rate
    return {"langs": langs, "gram": dict(zip(table.index, smooth.astype(np.float32))),
            "script": {s: (row >= MIN_SCRIPT).to_numpy() for s, row in share.iterrows()}}


class Scorer:
    """Scores of words per language; remembers words up to a bound."""

    def __init__(self, model: dict):
        self.n = max(len(model["langs"]), 1)
        self.row = {g: i for i, g in enumerate(model["gram"])}
        self.grams = np.array([*model["gram"].values(), np.zeros(self.n)], np.float32).reshape(-1, self.n)  # the last row is for unknown ones
        ok = [model["script"].get(s, np.zeros(self.n, bool)) for s in SCRIPT_OF]
        self.barred = np.array([np.where(x, 0, -1e4) if x.any() else np.zeros(self.n) for x in ok], np.float32)
        self.forget()

    def forget(self):
        self.words, self.table, self.letters = Vocabulary(), np.zeros((0, self.n), np.float32), np.zeros(0, np.int64)

    def learn(self, fresh: list[str]) -> None:
        find = self.row.get
        rows = np.array([find(g, -1) for w in fresh for g in grams(w)], np.int64)
        starts = offsets(np.array([len(w) + 1 for w in fresh], np.int64))[:-1]  # a word has as many sequences as letters, and itself
        scores = np.add.reduceat(self.grams[rows], starts) + self.barred[np.searchsorted(STARTS, [ord(w[0]) for w in fresh], "right") - 1]
        self.table = np.concatenate([self.table, scores])
        self.letters = np.concatenate([self.letters, [len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in fresh]])

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word scores of all texts end to end, words per text, letters per word."""
        if len(self.words) > CACHE_WORDS:
            self.forget()
        number = self.words.__getitem__
        found = [np.array(list(map(number, WORDS(t.lower()))), np.int64) for t in texts]
        if self.words.fresh:
            self.learn(self.words.fresh)
            self.words.fresh = []
        ids = np.concatenate([np.zeros(0, np.int64), *found])
        return self.table[ids], np.array([len(f) for f in found], np.int64), self.letters[ids]


def label(df: DataFrame, model: dict, text: str = "text", penalty: float = PENALTY) -> DataFrame:
    """``df`` with lang_pred, score (share of the letters in its spans) and spans."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", T.DataType.fromDDL(SPANS))])

    def make():
        scorer, langs = Scorer(shared.value), shared.value["langs"]
        names = np.array(langs + ["und"], object)

        def run(col):
            scores, lens, letters = scorer(texts_of(col))
            letters = letters if langs else letters * 0
            states = chains.viterbi(scores, lens, penalty)
            owner = np.repeat(np.arange(len(lens)), lens)
            votes = np.bincount(owner * max(len(langs), 1) + states, letters, len(lens) * max(len(langs), 1)).reshape(len(lens), -1)
            total = votes.sum(axis=1)
            pred = np.where(total > 0, votes.argmax(axis=1), len(langs))
            first, count, per_text = chains.runs(states, lens)
            word = first - np.repeat(offsets(lens)[:-1], per_text)
            spans = chains.list_of_structs(per_text, {"first_word": pa.array(word, pa.int32()), "last_word": pa.array(word + count - 1, pa.int32()), "lang": pa.array(names[states[first]], pa.string())})
            return [pa.array(names[pred], pa.string()), pa.array(np.where(total > 0, votes.max(axis=1) / np.maximum(total, 1), 0.0), pa.float64()), spans]

        return run

    return arrow_columns(df, [text], fields, make)

