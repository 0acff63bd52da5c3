"""Byte-level BPE: batched numpy merge rounds over the symbols of many words in one flat array.

``encode`` adds the token ids of each text as little-endian unsigned 32-bit integers (a binary column),
``decode`` turns such a column into text again. Both work batch by batch inside the tasks: no shuffle, and the
state of a task is the vocabulary file plus a bounded cache of words that it has met.

Null and empty texts have no ids and decode to the empty text; rows are never joined or dropped, so repeated rows
and tables without rows need no care; an output column replaces one of the same name. Words of any length are
encoded whole: a round costs time in proportion to the symbols that are left in the words still unfinished.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vigil.llm.common import Vocabulary, arrow_columns, offsets, ragged, texts_of

#: Chunks and ids that a task remembers before it starts its cache anew.
CACHE_WORDS = 800_000
CACHE_IDS = 8_000_000
#: The word pattern of byte-level BPE and the byte alphabet below are the format of the tokenizer file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = np.iinfo(np.int64).max


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(shown))}
    return [rest.get(b, chr(b)) for b in range(256)]


@dataclass
class Tables:
    """A tokenizer file as sorted arrays. keys: left id * size + right id, ascending; rank: of each key; made: id by rank."""

    keys: np.ndarray
    rank: np.ndarray
    made: np.ndarray
    byte_id: np.ndarray
    token_bytes: np.ndarray
    token_at: np.ndarray
    special: dict
    size: int


def load(path: str) -> Tables:
    """Read a byte-level BPE tokenizer file (JSON: vocab, merges, added tokens)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    size = max([*vocab.values(), *special.values()]) + 1
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
    order = np.argsort(keys, kind="stable")
    to_byte = {c: b for b, c in enumerate(alphabet)}
    raw = [b""] * size
    for token, i in {**vocab, **special}.items():
        raw[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
    return Tables(
        keys[order], order.astype(np.int64), np.array([vocab[a + b] for a, b in pairs], np.int64),
        np.array([vocab[c] for c in alphabet], np.int64), np.frombuffer(b"".join(raw), np.uint8),
        offsets(np.array([len(x) for x in raw], np.int64)), special, size)


def pair_ranks(t: Tables, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of each pair by binary search over the sorted keys, NO_RANK for pairs that never merge."""
    key = left * t.size + right
    at = np.minimum(np.searchsorted(t.keys, key), len(t.keys) - 1)
    return np.where(t.keys[at] == key, t.rank[at], NO_RANK)


def merge_rounds(t: Tables, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and the number of ids of each word.

    In each round every unfinished word merges all places of its lowest-ranked pair, from the left where places
    overlap. Only pairs beside a merge are looked up again; words without a pair left leave the flat array.
    """
    lens = np.array([len(w) for w in words], np.int64)
    sym = t.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), lens)
    rank = np.full(len(sym), NO_RANK)
    inner = np.flatnonzero(word[:-1] == word[1:])
    rank[inner] = pair_ranks(t, sym[inner], sym[inner + 1])
    done_word, done_sym = [], []
    while len(sym):
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        best = np.minimum.reduceat(rank, first)
        count = np.diff(np.append(first, len(sym)))
        best_of = np.repeat(best, count)
        over = best_of == NO_RANK
        if over.any():
            done_word.append(word[over])
            done_sym.append(sym[over])
            sym, word, rank, best_of = sym[~over], word[~over], rank[~over], best_of[~over]
            if not len(sym):
                break
        at = np.flatnonzero(rank == best_of)
        # places that overlap follow one another: of such a run, every second is merged
        run = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1]))
        nth = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        at = at[nth % 2 == 0]
        sym[at] = t.made[rank[at]]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        sym, word, rank = sym[keep], word[keep], rank[keep]
        at = at - np.arange(len(at))
        beside = np.zeros(len(sym) + 1, bool)
        beside[at] = beside[at - 1] = True  # before the first place lies the spare last one
        again = np.flatnonzero(beside[:-1])
        rank[again] = NO_RANK
        again = again[again < len(sym) - 1]
        again = again[word[again] == word[again + 1]]
        rank[again] = pair_ranks(t, sym[again], sym[again + 1])
    if not done_word:
        return np.zeros(0, np.int64), lens
    word, sym = np.concatenate(done_word), np.concatenate(done_sym)
    order = np.argsort(word, kind="stable")
    return sym[order], np.bincount(word, minlength=len(words))


class Encoder:
    """Encodes lists of texts; remembers the ids of chunks it has met, up to the cache's bounds.

    No word of the pattern crosses the place before a lone space or line end that has other characters than white
    space on both sides, so a text without white space beside white space falls into chunks there, each cut into
    words only once. Other texts are cut as a whole.
    """

    def __init__(self, t: Tables):
        self.t, self.find = t, regex.compile(PATTERN).findall
        self.split = regex.compile("|".join(regex.escape(s) for s in sorted(t.special, key=len, reverse=True))) if t.special else None
        self.double = re.compile(r"\s\s|^\s|\s$").search
        self.forget()

    def forget(self):
        self.chunks, self.ids, self.at = Vocabulary(), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def pieces(self, text: str) -> list:
        """The words of a text without special tokens."""
        out, end = [], 0
        for m in self.split.finditer(text) if self.split else ():
            out += [*self.find(text[end:m.start()]), (self.t.special[m.group()],)]
            end = m.end()
        return out + self.find(text[end:])

    def cut(self, text: str) -> list:
        """Chunks of a text: a tuple holds a chunk as it is, a string one that a space stands before (or its own line end)."""
        if self.double(text) or self.split and self.split.search(text):
            return [(text,)]
        first, *rest = text.replace("\n", " \n").split(" ")
        return [(first,), *rest]

    def learn(self, fresh: list) -> None:
        known = Vocabulary()
        cut = [self.pieces(c[0] if isinstance(c, tuple) else c if c[0] == "\n" else " " + c) for c in fresh]
        number = [known[w] for words in cut for w in words]
        ids, lens = merge_rounds(self.t, [b"" if isinstance(w, tuple) else w.encode() for w in known])
        special = [i for i, w in enumerate(known) if isinstance(w, tuple)]  # one id each
        ids = np.insert(ids, offsets(lens)[special], [w[0] for w in known if isinstance(w, tuple)])
        lens[special] = 1
        number = np.array(number, np.int64)
        ids = ids[ragged(offsets(lens)[number], lens[number])]
        of_chunk = np.diff(offsets(lens[number])[offsets(np.array([len(x) for x in cut], np.int64))])
        self.ids = np.concatenate([self.ids, ids])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(of_chunk)])

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.chunks) > CACHE_WORDS or len(self.ids) > CACHE_IDS:
            self.forget()
        number = self.chunks.__getitem__
        numbers = [np.array(list(map(number, self.cut(t))), np.int64) for t in texts]
        if self.chunks.fresh:
            self.learn(self.chunks.fresh)
            self.chunks.fresh = []
        return [self.ids[ragged(self.at[n], self.at[n + 1] - self.at[n])] for n in numbers]


def decode_ids(t: Tables, ids: np.ndarray) -> str:
    raw = t.token_bytes[ragged(t.token_at[ids], t.token_at[ids + 1] - t.token_at[ids])]
    return raw.tobytes().decode("utf-8", "replace")


def encode(df: DataFrame, tokenizer: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the ids of column ``text``. The file ``tokenizer`` is read once, on the driver, and sent to the tasks."""
    shared = df.sparkSession.sparkContext.broadcast(load(tokenizer))

    def make():
        enc = Encoder(shared.value)
        return lambda col: [pa.array([x.astype("<u4").tobytes() for x in enc(texts_of(col))], pa.binary())]

    return arrow_columns(df, [text], T.StructType([T.StructField(out, T.BinaryType())]), make)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids in column ``ids`` (special tokens as their strings; broken UTF-8 as U+FFFD)."""
    shared = df.sparkSession.sparkContext.broadcast(load(tokenizer))

    def make():
        return lambda col: [pa.array([decode_ids(shared.value, np.frombuffer(x or b"", "<u4").astype(np.int64)) for x in col.to_pylist()], pa.string())]

    return arrow_columns(df, [ids], T.StructType([T.StructField(out, T.StringType())]), make)
