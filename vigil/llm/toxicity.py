"""Toxicity: a linear-chain conditional random field tags toxic words, marginals give document scores and offsets.

Only texts are labelled, so ``fit`` labels tokens first: a feature of words (the word, or its first 4 to 6 letters) is
telling if it occurs in toxic texts far beyond chance and hardly in others; words of toxic texts with a telling
feature are toxic tokens. The field has two states; its weights are fitted on those labels by the gradient of the
log-likelihood (expected against labelled features and steps, from forward and backward sums). Chains are sentences.

``score`` gives each whole text the largest marginal of its words, and the spans of code points [start, end) of
neighbouring words that are toxic more likely than not, with their largest marginal. The scores come from text alone.

Fitted on at most MAX_TOXIC + MAX_CLEAN labelled texts, those with the smallest hashes of their ids, in one task.
Null and empty texts and texts without a letter score 0 and have no span. Repeated rows are scored one by one; a table
without rows gives none. Without any labelled row every score is 0.
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

MAX_TOXIC, MAX_CLEAN = 1500, 3000
PREFIXES = (4, 5, 6)
#: Telling features: log-likelihood gain over chance, and the least share of their texts that is toxic.
MIN_GAIN, MIN_SHARE = 13.0, 0.95
STEPS, RATE, RIDGE = 30, 0.7, 0.002
#: Copies in the sample would make every word of theirs telling: texts that share a band of minima of hashed shingles count once.
SHINGLE, BANDS, ROWS = 5, 6, 2
KEEP_WEIGHT = 0.05
DECISION = 0.7
CACHE_WORDS = 600_000
TOKENS = re.compile(r"[^\W\d_]+|[.!?\n]").findall
WORD_AT = re.compile(r"[^\W\d_]+").finditer
ENDS = (".", "!", "?", "\n")
SPANS = "array<struct<start:int,end:int,probability:double>>"


def features(word: str) -> list[str]:
    w = word.lower()
    return [w] + [f"{w[:k]}*" for k in PREFIXES if len(w) >= k]


class Words:
    """Tokens as numbers; the first numbers are the sentence ends."""

    def __init__(self):
        self.number = Vocabulary()
        for end in ENDS:
            self.number[end]
        self.number.fresh = []

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of all texts end to end (numbers), the text of each, and the lengths of the sentences."""
        find = self.number.__getitem__
        found = [np.array(list(map(find, TOKENS(t))), np.int64) for t in texts]
        tokens = np.concatenate([np.zeros(0, np.int64), *found])
        owner = np.repeat(np.arange(len(texts)), [len(f) for f in found])
        word = tokens >= len(ENDS)
        sentence = np.cumsum(~word) + owner
        return tokens[word], owner[word], np.unique(sentence[word], return_counts=True)[1]


def telling(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Which features, by the numbers of toxic and clean texts that have them, mark toxic texts."""
    p = n_toxic / (n_toxic + n_clean)
    share = toxic / np.maximum(toxic + clean, 1)
    part = lambda n, q: n * np.log(np.maximum(q, 1e-12))
    gain = part(toxic, share / p) + np.where(clean > 0, part(clean, (1 - share) / (1 - p)), 0)
    return (gain >= MIN_GAIN) & (share >= MIN_SHARE)


def without_copies(ids: np.ndarray, owner: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """One text for each group of near copies with the same label, as numbers in ascending order."""
    n, rng = len(toxic), np.random.default_rng(5)
    mix = rng.integers(1, 2**63, SHINGLE + BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
    same = np.flatnonzero(owner[:len(owner) - SHINGLE + 1] == owner[SHINGLE - 1:]) if len(owner) >= SHINGLE else np.zeros(0, int)
    key = sum((ids[same + k].astype(np.uint64) + np.uint64(1)) * mix[k] for k in range(SHINGLE)) if len(same) else np.zeros(0, np.uint64)
    key ^= key >> np.uint64(31)
    group, first = np.arange(n), {}

    def root(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    texts, at = np.unique(owner[same], return_index=True)
    minima = [np.minimum.reduceat((key * m) ^ ((key * m) >> np.uint64(29)), at) if len(at) else key for m in mix[SHINGLE:]]
    for b in range(BANDS):
        for i, *band in zip(texts, *minima[ROWS * b:ROWS * (b + 1)]):
            j = first.setdefault((b, int(toxic[i]), *map(int, band)), i)
            group[max(root(i), root(j))] = min(root(i), root(j))
    return np.flatnonzero(group == np.arange(n))


def fit_field(texts: list[str], toxic: np.ndarray) -> dict:
    """Feature weights, bias, step scores and start score; ``toxic``: labels of the texts, 0 or 1."""
    if not len(toxic) or toxic.min() == toxic.max():
        return {"weights": {}, "bias": -30.0, "change": [[0.0, 0.0], [0.0, 0.0]], "start": 0.0}
    ids, owner, _ = Words()(texts)
    kept = without_copies(ids, owner, toxic)
    texts, toxic, words = [texts[i] for i in kept], toxic[kept], Words()
    ids, owner, lens = words(texts)
    names = Vocabulary()
    of_word = [[names[f] for f in features(w)] for w in words.number]
    n_of = np.array([len(x) for x in of_word])
    flat = np.array([f for x in of_word for f in x])
    at = offsets(n_of)[:-1]
    word_of = np.repeat(np.arange(len(of_word)), n_of)

    pairs = np.unique(owner * len(of_word) + ids)  # a word counts once a text
    text, word = pairs // len(of_word), pairs % len(of_word)
    got = np.repeat(text, n_of[word]) * len(names) + flat[np.repeat(at[word] - offsets(n_of[word])[:-1], n_of[word]) + np.arange(n_of[word].sum())]
    got = np.unique(got)
    label = toxic[got // len(names)]
    seen = [np.bincount(got[label == k] % len(names), minlength=len(names)) for k in (0, 1)]
    marks = telling(seen[1], seen[0], int(toxic.sum()), int((1 - toxic).sum()))
    y = (np.add.reduceat(marks[flat], at) > 0)[ids] & (toxic[owner] == 1)

    weight, bias, change, start = np.zeros(len(names)), np.log((y.sum() + 1) / (len(y) + 1)), np.zeros((2, 2)), 0.0
    inner = np.ones(len(y), bool)
    inner[offsets(lens)[:-1]] = False
    after = np.flatnonzero(inner)
    steps = np.bincount(2 * y[after - 1] + y[after], minlength=4).reshape(2, 2).astype(float)
    past_w, past = np.zeros(len(names)), np.zeros(6)
    for _ in range(STEPS):
        of = np.add.reduceat(weight[flat], at) + bias
        expected = np.zeros((2, 2))
        p = chains.marginals(of[ids], lens, change, start, expected)
        miss = y - p
        g = np.bincount(flat, np.bincount(ids, miss, len(of_word))[word_of], len(names)) - RIDGE * weight * len(texts) ** 0.5
        rest = np.concatenate([[miss.sum()], (steps - expected).ravel(), [miss[~inner].sum()]])
        past_w += g * g
        past += rest * rest
        weight += RATE * g / (np.sqrt(past_w) + 1)  # features that are rarely wrong stay near 0
        move = RATE * rest / (np.sqrt(past) + 1)
        bias, change, start = bias + move[0], change + move[1:5].reshape(2, 2), start + move[5]
    keep = np.abs(weight) >= KEEP_WEIGHT
    return {"weights": {f: float(weight[i]) for f, i in names.items() if keep[i]}, "bias": float(bias), "change": change.tolist(), "start": float(start)}


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> dict:
    """Model from the labelled rows that are not held out; sampled by id, joined by a broadcast of at most
    MAX_TOXIC + MAX_CLEAN ids, fitted in one task on that many texts."""
    known = labels.filter(~held_out(key) & F.col(label).isin(0, 1)).select(key, label).distinct()
    first = lambda y, n: known.filter(F.col(label) == y).orderBy(F.xxhash64(F.lit(7), F.col(key)), key).limit(n)
    ids = F.broadcast(first(1, MAX_TOXIC).unionByName(first(0, MAX_CLEAN)))

    def run(batches):
        texts, toxic = [], []
        for b in batches:
            texts += texts_of(b.column(0))
            toxic += b.column(1).to_pylist()
        # rows come in any order: put them in one, so that a rerun adds up the same sums in the same order
        order = sorted(range(len(texts)), key=lambda i: (texts[i], toxic[i]))
        m = fit_field([texts[i] for i in order], np.array([toxic[i] for i in order], np.int64))
        yield pa.RecordBatch.from_pydict({"feature": [list(m["weights"])], "weight": [list(m["weights"].values())], "rest": [[m["bias"], *m["change"][0], *m["change"][1], m["start"]]]})

    row = docs.select(key, text).join(ids, key).select(text, label).repartition(1).mapInArrow(run, "feature array<string>, weight array<double>, rest array<double>").first()
    if row is None:
        return fit_field([], np.zeros(0, np.int64))
    b = row["rest"]
    return {"weights": dict(zip(row["feature"], row["weight"])), "bias": b[0], "change": [b[1:3], b[3:5]], "start": b[5]}


class Tagger:
    """Marginals of the words of texts; remembers scores of words up to a bound."""

    def __init__(self, model: dict):
        self.model, self.change = model, np.array(model["change"])
        self.forget()

    def forget(self):
        self.words, self.odds = Words(), np.zeros(len(ENDS))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Marginal of each word, and the number of its text."""
        if len(self.words.number) > CACHE_WORDS:
            self.forget()
        ids, owner, lens = self.words(texts)
        if fresh := self.words.number.fresh:
            weight = self.model["weights"].get
            self.odds = np.concatenate([self.odds, [self.model["bias"] + sum(weight(f, 0.0) for f in features(w)) for w in fresh]])
            self.words.number.fresh = []
        return chains.marginals(self.odds[ids], lens, self.change, self.model["start"]), owner


def score(df: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``df`` with score, predicted (1 from DECISION on) and spans."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("spans", T.DataType.fromDDL(SPANS))])

    def make():
        tagger = Tagger(shared.value)

        def run(col):
            texts = texts_of(col)
            p, owner = tagger(texts)
            best = np.zeros(len(texts))
            np.maximum.at(best, owner, p)
            counts, start, end, prob = np.zeros(len(texts), np.int64), [], [], []
            per_text = np.bincount(owner, minlength=len(texts))
            at = offsets(per_text)
            for i in np.flatnonzero(best >= 0.5):
                places, own = [m.span() for m in WORD_AT(texts[i])], p[at[i]:at[i + 1]]
                first, n, _ = chains.runs(own >= 0.5, per_text[i:i + 1])
                for f, k in zip(first, n):
                    if own[f] >= 0.5:
                        counts[i] += 1
                        start.append(places[f][0])
                        end.append(places[f + k - 1][1])
                        prob.append(float(own[f:f + k].max()))
            spans = chains.list_of_structs(counts, {"start": pa.array(start, pa.int32()), "end": pa.array(end, pa.int32()), "probability": pa.array(prob, pa.float64())})
            return [pa.array(best), pa.array((best >= DECISION).astype(np.int32)), spans]

        return run

    return arrow_columns(df, [text], fields, make)
