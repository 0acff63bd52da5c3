"""Packing: every piece once and gapless, ids as the tokenizers library cuts them, and few sequences."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from vigil.llm import bpe, packing
from vigil.llm.queries import tokenizer_path


def least(items, size):
    """Fewest sequences for a few items, by trying every way to put each item, longest first, into an open sequence or a new one."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k, r in enumerate(rooms):
            if r >= items[i] and r not in rooms[:k]:
                go(i + 1, rooms[:k] + [r - items[i]] + rooms[k + 1:])
        go(i + 1, [*rooms, size - items[i]])

    go(0, [])
    return best[0]


def check(counts, packed, size):
    got = np.zeros(size + 1, np.int64)
    for n, row in packed.configs:
        assert n > 0 and 0 < sum(row) <= size
        np.add.at(got, list(row), n)
    assert got.tolist() == list(counts)
    assert packed.bound <= packed.sequences + 1e-6


def test_few_items_against_all_ways():
    rng = np.random.default_rng(3)
    over = 0
    for _ in range(40):
        items = rng.integers(1, 17, 10)
        counts = np.bincount(items, minlength=17)
        packed = packing.solve(counts, 16)
        check(counts, packed, 16)
        over += packed.sequences - least(items.tolist(), 16)
    assert over <= 2


@pytest.mark.parametrize("shape", ["uniform", "thirds", "one", "ones", "none", "rare"])
def test_many_items_near_the_bound(shape):
    size, k = 1024, np.arange(1025)
    rng = np.random.default_rng(4)
    counts = {"uniform": rng.integers(0, 60, 1025), "thirds": np.where((k > 250) & (k < 400), 300, 0), "one": np.where(k == 342, 1001, 0), "ones": np.where(k == 1, 5000, 0),
              "none": np.zeros(1025, np.int64), "rare": np.where(k % 97 == 3, 1, 0) + np.where(k == 500, 400, 0)}[shape]
    counts[0] = 0
    packed = packing.solve(counts, size)
    check(counts, packed, size)
    assert packed.bound >= (counts * k).sum() / size - 1e-6
    assert packed.sequences <= {"uniform": packed.bound * 1.01, "thirds": packed.bound * 1.035, "one": 501, "ones": 5, "none": 0, "rare": 206}[shape]


def rows_of(texts, size=1024):
    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    out = []
    for i, x in texts:
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids) + 1, size)]
        out += [(i, p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(itertools.pairwise(cuts))]
    return out


def test_ids_of_odd_texts():
    tables = bpe.load(tokenizer_path())
    encode, other = packing.ids_of(tables), bpe.Encoder(tables)
    for text in ("", " " * 1_500_000 + "x", "\n" * 1_200_000, "a  b\n\n  c<|endoftext|> <|endoftext|>x", "\u0085  x　y", "'s I'll 123 ½²³ éá", "a" * 200_000):
        assert encode(text).tolist() == other([text])[0].tolist()


def test_pieces_and_places(spark, edge, edge_rows, empty):
    for size in (1024, 16):
        clash = edge.withColumn("start", edge.doc_id).withColumn("sequence_id", edge.kept).withColumn("__task", edge.kept)
        packed, found = packing.pack(clash.repartition(3), tokenizer_path(), size=size)
        assert packed.columns == ["doc_id", "lang", "source", "n_chars", "rank", "kept", "ids", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        rows = packed.collect()
        assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows], key=lambda r: (r[0] is None, r[0] or 0, *r[1:])) == sorted(
            rows_of([(r[0], r[1]) for r in edge_rows], size), key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))
        places = defaultdict(list)
        for r in rows:
            places[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(places) == found.sequences
        for spans in places.values():
            at = 0
            for offset, length in sorted(spans):
                assert offset == at
                at += length
            assert at <= size
    assert packing.pack(empty, tokenizer_path())[0].count() == 0


def test_whole_table(spark, small_rows):
    df = spark.createDataFrame([(r[0], r[1]) for r in small_rows], "doc_id long, text string")
    packed, found = packing.pack(df, tokenizer_path())
    rows = packed.collect()
    assert sorted(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows) == sorted(rows_of([(r[0], r[1]) for r in small_rows]))
    assert len({r["sequence_id"] for r in rows}) == found.sequences <= found.bound * 1.02 + 1
