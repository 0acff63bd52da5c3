import hashlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from tests.llm.conftest import SMALL
from vigil.llm import bpe, queries

PATH = P.path("byte_bpe_50k.json")
ODD = ["", "a", "  hi\x1c\x1d\u0085  x  \n\n y", "<|endoftext|>abc<|endoftext|><|endoftext|>", "a" * 999, "日本語👍🏽 ١٢٣ ñandú'll don't  ", "x" * 3000 + " " * 77, "​﻿\x00",
       "a" * 10001 + "bc" * 3000, "a\n", "\n", "a\nb", "a \nb", " a", "it's\n's 's", "a b c\n\td"]


def test_ids_and_text_equal_the_librarys(small_rows):
    lib, tables = Tokenizer.from_file(PATH), bpe.load(PATH)
    texts = ODD + [r[1] or "" for r in small_rows]
    for ids, text in zip(bpe.Encoder(tables)(texts), texts):
        assert ids.tolist() == lib.encode(text, add_special_tokens=False).ids
        assert bpe.decode_ids(tables, ids) == lib.decode(ids.tolist(), skip_special_tokens=False)


def test_cache_that_starts_anew_changes_nothing(monkeypatch, small_rows):
    texts = [r[1] or "" for r in small_rows]
    whole = bpe.Encoder(bpe.load(PATH))(texts)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    enc = bpe.Encoder(bpe.load(PATH))
    again = [x for t in texts for x in enc([t])]
    assert all(np.array_equal(a, b) for a, b in zip(whole, again))


def test_edge_rows_and_empty_table(edge, empty, edge_rows):
    out = bpe.decode(bpe.encode(edge, PATH), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["decoded"]) for r in out) == sorted((r[0] or 0, r[1] or "") for r in edge_rows)
    assert bpe.decode(bpe.encode(empty, PATH), PATH).count() == 0


def test_query(spark, small_rows):
    lib = Tokenizer.from_file(PATH)
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_bpe_encode_decode"](spark, SMALL).collect()}
    assert len(got) == len(small_rows)
    for i, text, *_ in small_rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
