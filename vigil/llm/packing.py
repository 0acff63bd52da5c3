"""Packing token sequences into rows of a fixed size: a configuration linear program, rounded, with best fit for the rest.

Documents longer than ``size`` are cut into pieces of ``size`` (the first piece may be shorter), so all there is to pack is
counts of the lengths 1..size: a histogram of at most ``size`` numbers, whatever the input. A configuration is a set of lengths
that fits one sequence. The program (use as few configurations as cover every length's count) is solved by multiplicative
weights: each round prices a length by its size and a weight that falls as its demand is covered; a dynamic program
over the room left finds the dearest configuration (a knapsack), and, from the same table, the dearest that holds each length;
those near the best take a step. Whole copies of the solution are taken (rounding down); what is left is covered by rounds of
the same pricing whose steps are whole copies, and the last items go by best fit, longest first. Every pricing gives a
lower bound (prices over the dearest configuration's value), which is reported.

The plan lists slots: for each length, runs of consecutive ranks with the sequence and offset of the first. Pieces get their
rank by length from counts of (task, length), no task sees all of one length, and look their slot up in the plan, which
tasks hold whole: it is bounded by the rounds and ``size``, not by the rows. Equal lengths are interchangeable, so ties need no rule; repeated
rows are packed one by one; a null text is empty (its end token alone); a table without rows gives none. Other columns
are kept under their own names unless a column of the result has that name; those are left out.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import bpe
from vigil.llm.common import cut_batch, texts_of, written

SIZE, END = 1024, 2
#: Rounds, and settings tried: how hard weights react to coverage, how near the best a configuration must be, the share of a demand that one
#: step may cover, and the nearness while rounding. The packing with the fewest sequences is taken.
LP_ROUNDS, WHOLE_ROUNDS = 120, 300
SETTINGS = ((0.0, 0.3, 0.02, 0.3, 0.05), (0.0, 0.3, 0.02, 0.3, 0.02), (1.0, 0.3, 0.02, 0.3, 0.02))
WHOLE_REACT, WHOLE_STEP = 0.3, 0.1
LEFT = 0.003


@dataclass
class Packing:
    """configs: copies and lengths of each configuration; bound: no packing has fewer sequences."""

    size: int
    configs: list = field(default_factory=list)
    bound: float = 0.0

    @property
    def sequences(self) -> int:
        return sum(n for n, _ in self.configs)


def knapsack(price: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room: the most that lengths worth ``price`` reach in it, and a last length of such a choice (0: leave one unit)."""
    worth = np.full(size + 1, -1.0)
    worth[lengths] = price
    value, last = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    for room in range(1, size + 1):
        ways = worth[1:room + 1] + value[room - 1::-1]
        k = room - 1 - int(ways[::-1].argmax())  # of equal choices the longest: short items fill gaps best, later
        value[room], last[room] = (ways[k], k + 1) if ways[k] > value[room - 1] else (value[room - 1], 0)
    return value, last


def dearest(last: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """For each length a row: the dearest configuration that holds it, as lengths, filled up with zeros."""
    shrink = np.arange(size + 1)
    for room in range(1, size + 1):
        if not last[room]:
            shrink[room] = shrink[room - 1]
    room, rows = shrink[size - lengths], [lengths]
    while room.any():
        rows.append(last[room])
        room = shrink[room - last[room]]
    return np.array(rows).T


def near_best(price: np.ndarray, lengths: np.ndarray, size: int, near: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Configurations within ``near`` of the dearest, the lengths they were built for (as places), dearest first, and its value."""
    value, last = knapsack(price, lengths, size)
    worth = price + value[size - lengths]
    order = np.argsort(-worth, kind="stable")
    good = order[worth[order] >= (1 - near) * value[size]]
    return dearest(last, lengths, size)[good], good, float(value[size])


def fractional(counts: np.ndarray, worth: np.ndarray, react: float, near: float, step: float, size: int) -> tuple[list, float]:
    """The program by multiplicative weights: (amount, lengths) of the configurations used, and the best lower bound met."""
    demand, sizes, bound = counts.astype(float), np.arange(size + 1), 0.0
    whole, mark, amounts = float((counts * sizes).sum()), np.random.default_rng(1).integers(1, 1 << 62, size + 1), {}
    mark[0] = 0
    for _ in range(LP_ROUNDS):
        lengths = np.flatnonzero(demand > 1e-9)
        if (demand * sizes).sum() <= LEFT * whole:
            break
        covered = 1 - demand[lengths] / counts[lengths]
        weight = np.exp(-react * (covered - covered.min()))
        price = weight * worth[lengths]
        rows, good, best = near_best(price, lengths, size, near)
        bound = max(bound, float(counts[lengths] @ price) / best)
        wish = (demand[lengths] * weight)[good]

        def cover(x):
            return np.bincount(rows.ravel(), np.repeat(x, rows.shape[1]), size + 1)

        asked = cover(wish)
        asked[0] = 0
        part = np.full(size + 1, np.inf)
        part[asked > 0] = step * demand[asked > 0] / asked[asked > 0]
        amount = wish * part[rows].min(1)
        done = cover(amount)
        done[0] = 0
        demand = np.maximum(demand - done, 0)
        for key, a, row in zip(mark[rows].sum(1).tolist(), amount.tolist(), rows):
            amounts.setdefault(key, [0.0, row])[0] += a
    return [(a, row[row > 0]) for a, row in amounts.values()], bound


def in_whole(counts: np.ndarray, left: np.ndarray, worth: np.ndarray, near: float, size: int) -> list:
    """Rounds whose steps are whole copies; takes what it covers off ``left``."""
    out, at_most = [], np.maximum(counts, 1)
    for _ in range(WHOLE_ROUNDS):
        lengths = np.flatnonzero(left)
        if not len(lengths):
            break
        covered = 1 - left[lengths] / at_most[lengths]
        rows, _, _ = near_best(np.exp(-WHOLE_REACT * (covered - covered.min())) * worth[lengths], lengths, size, near)
        floor, took = np.floor(left * (1 - WHOLE_STEP)).astype(np.int64), False
        for row in rows:
            row = row[row > 0]
            free = left[row] - floor[row]
            if free.min() <= 0:
                continue
            item, times = np.unique(row, return_counts=True)
            copies = int(((left[item] - floor[item]) // times).min())
            if copies > 0:
                left[item] -= copies * times
                out.append((copies, row))
                took = True
        if not took:
            break
    return out


def best_fit(left: np.ndarray, configs: list, size: int) -> list:
    """The items of ``left``, longest first, each into the sequence with the least room that holds it, over counts of alike sequences."""
    room = [[] for _ in range(size + 1)]
    for copies, row in configs:
        row = tuple(int(x) for x in row)
        room[size - sum(row)].append((copies, row))
    for length in range(size, 0, -1):
        n, at = int(left[length]), length
        while n:
            while at <= size and not room[at]:
                at += 1
            copies, row = room[at].pop() if at <= size else (n, ())
            space = at if at <= size else size
            times = min(space // length, n)
            use = min(copies, n // times)
            if copies > use and at <= size:
                room[space].append((copies - use, row))
            room[space - times * length].append((use, row + (length,) * times))
            n -= use * times
            at = length
    return [c for group in room for c in group]


def solve(counts: np.ndarray, size: int = SIZE) -> Packing:
    """Packs ``counts[l]`` items of each length l <= size."""
    counts = np.asarray(counts, np.int64)
    full, counts = int(counts[size]), np.where(np.arange(size + 1) < size, counts, 0)
    best = None
    for halves, react, near, step, near_whole in SETTINGS if counts.any() else ():
        left, taken = counts.copy(), []
        worth = np.arange(size + 1) / size + halves * (np.arange(size + 1) > size / 2)
        solution, bound = fractional(counts, worth, react, near, step, size)
        for amount, row in solution:
            copies = int(amount + 1e-7)
            if copies:
                np.subtract.at(left, row, copies)
                taken.append((copies, row))
        taken += in_whole(counts, left, worth, near_whole, size)
        found = Packing(size, best_fit(left, taken, size), bound)
        if best is None or found.sequences < best.sequences:
            found.bound = max(bound, best.bound if best else 0.0)
            best = found
        else:
            best.bound = max(bound, best.bound)
    best = best or Packing(size)
    if full:
        best = Packing(size, [*best.configs, (full, (size,))], best.bound + full)
    return best


def slots(packing: Packing) -> dict[str, np.ndarray]:
    """Runs of slots by (length, first rank): the sequence and the offset of the first slot; each next rank is the next sequence."""
    out, sequence, rank = [], 0, np.zeros(packing.size + 1, np.int64)
    for copies, row in packing.configs:
        offset = 0
        for length in row:
            out.append((length, int(rank[length]), sequence, offset))
            rank[length] += copies
            offset += length
        sequence += copies
    table = np.array(sorted(out), np.int64).reshape(-1, 4)
    return dict(zip(("length", "first", "sequence", "offset"), table.T))


PIECE = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
PLACE = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
INNER = ("__task", "__nth")


@lru_cache(maxsize=2)
def coder(ranks: tuple, special: tuple) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizer file whose ids of merged tokens follow the order of the merges."""
    return tiktoken.Encoding("packing", pat_str=bpe.PATTERN, mergeable_ranks=dict(ranks), special_tokens=dict(special))


def vocabulary(t: bpe.Tables) -> tuple[tuple, tuple]:
    """(bytes, id) of the plain tokens and (text, id) of the special ones of a tokenizer file."""
    if np.any(np.diff(t.made) <= 0):
        raise ValueError("the ids of merged tokens must follow the order of the merges")
    raw, special = t.token_bytes.tobytes(), set(t.special.values())
    return tuple((raw[t.token_at[i]:t.token_at[i + 1]], i) for i in range(t.size) if i not in special and t.token_at[i] < t.token_at[i + 1]), tuple(t.special.items())


def ids_of(tables: bpe.Tables):
    """A function from a text to its ids. The library's pattern search has a bounded stack, which a run of a million
    spaces passes; such texts are encoded by the operator in ``bpe``, to the same ids."""
    encode, other = coder(*vocabulary(tables)).encode_to_numpy, []

    def run(text: str) -> np.ndarray:
        try:
            return encode(text, allowed_special="all")
        except ValueError:
            if not other:
                other.append(bpe.Encoder(tables))
            return other[0]([text])[0]

    return run


def pieces(df: DataFrame, tokenizer: str, text: str = "text", size: int = SIZE, end: int = END) -> DataFrame:
    """A row for each piece of each document's ids and ``end``, with the columns of PIECE, the task that cut it and its number among the task's pieces of its length."""
    keep = [c for c in df.columns if c not in (text, *PIECE.fieldNames(), *PLACE.fieldNames(), *INNER)]
    schema = T.StructType([df.schema[c] for c in keep] + list(PIECE) + [T.StructField("__task", T.IntegerType()), T.StructField("__nth", T.LongType())])
    shared = df.sparkSession.sparkContext.broadcast(bpe.load(tokenizer))

    def run(batches):
        encode, task, met = ids_of(shared.value), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            for part in cut_batch(batch, [text]):
                row, piece, start, length, crc, nth = [], [], [], [], [], []
                for i, t in enumerate(texts_of(part.column(part.schema.get_field_index(text)))):
                    raw = np.append(encode(t), end).astype("<u4")
                    first = (len(raw) - 1) % size + 1
                    for p, lo in enumerate([0, *range(first, len(raw), size)]):
                        hi = first if p == 0 else lo + size
                        row.append(i)
                        piece.append(p)
                        start.append(lo)
                        length.append(hi - lo)
                        crc.append(zlib.crc32(raw[lo:hi].tobytes()))
                        nth.append(met[hi - lo])
                        met[hi - lo] += 1
                at = pa.array(row, pa.int64())
                cols = [part.column(part.schema.get_field_index(c)).take(at) for c in keep]
                cols += [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                         pa.array([task] * len(row), pa.int32()), pa.array(nth, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=schema.fieldNames())

    return df.select(*keep, text).mapInArrow(run, schema)


def pack(df: DataFrame, tokenizer: str, text: str = "text", size: int = SIZE, end: int = END) -> tuple[DataFrame, Packing]:
    """The pieces of all documents with their sequence and offset, and the packing (sequences, lower bound)."""
    cut = written(pieces(df, tokenizer, text, size, end))
    counts = written(cut.groupBy("__task", "length").agg(F.count(F.lit(1)).alias("n")))
    lengths = np.zeros(size + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        lengths[r["length"]] = r["n"]
    packing = solve(lengths, size)
    plan = df.sparkSession.sparkContext.broadcast(slots(packing))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select(F.col("__task").alias("__t"), F.col("length").alias("__l"), F.coalesce(before, F.lit(0)).alias("__base"))
    placed = cut.join(base, (F.col("__task") == F.col("__t")) & (F.col("length") == F.col("__l"))).withColumn("__rank", F.col("__base") + F.col("__nth")).drop("__t", "__l", "__base", *INNER)
    keep = [c for c in placed.columns if c != "__rank"]
    schema = T.StructType([placed.schema[c] for c in keep] + list(PLACE))

    def run(batches):
        runs = plan.value
        wide = int(runs["first"].max()) + 1 if len(runs["first"]) else 1
        keys = runs["length"] * wide + runs["first"]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "__rank"))
            at = np.searchsorted(keys, length * wide + np.minimum(rank, wide - 1), "right") - 1
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            cols += [pa.array(runs["sequence"][at] + rank - runs["first"][at]), pa.array(runs["offset"][at])]
            yield pa.RecordBatch.from_arrays(cols, names=schema.fieldNames())

    return placed.mapInArrow(run, schema), packing
