"""Shared fixtures: a table of awkward documents, an empty one, and the smallest given tables."""

import glob

import pyarrow.parquet as pq
import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, kept string, ids string"
LONG = "Thre ounder ofthe\n" * 4000 + "a" * 30000


@pytest.fixture(scope="session")
def edge_rows():
    texts = [(1, None), (2, ""), (3, "   \n\t\n "), (4, "one"), (4, "one"), (5, LONG), (6, "Released under the MIT License.\nunder the mit license under the mit license"),
             (7, "cc by nc CC-BY-NC 4.0\nLicensed under CC BY-NC 4.0"), (8, "日本 é\u0085x \U0001f600\n" * 30), (None, "no id"), (9, LONG), (10, "ab " * 200), (11, "ab " * 200), (12, "<|endoftext|>x<|endoftext|>")]
    return [(i, t, [None, "en", "fr"][k % 3], [None, "s1", "s2", "s1"][k % 4], 0 if t is None else len(t), 7, "x", "y") for k, (i, t) in enumerate(texts)]


@pytest.fixture()
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_rows():
    paths = sorted(glob.glob(f"{SMALL}/documents.parquet"))
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for p in paths for r in pq.read_table(p).to_pylist()]
