import base64
import hashlib

import pyarrow.parquet as pq
import zstandard

from tests.llm.conftest import SMALL
from vigil.llm import queries, warc


def brute(pages, least=0):
    last = {}
    for i, _, h in pages:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    out = []
    for i, _, h in pages:
        raw = (h or "").encode()
        again = len(raw) >= least and last[h or ""] != (-1 if i is None else i)
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", last[h or ""] if again else None))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


ODD = [(1, "http://a/ü\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", "x\r\n\r\nWARC/1.1\r\n" * 3), (6, "u", "é" * 300000), (7, "u", "same"), (7, "u", "same"), (None, "u", "z"), (9, "u", "z"), (10, "u", "only")]


def test_query_equals_brute_force(spark):
    pages = [(r["page_id"], r["url"], r["html"]) for r in pq.read_table(f"{SMALL}/pages.parquet").to_pylist()]
    assert rows(queries.QUERIES["op5_warc_dictionary"](spark, SMALL)) == brute(pages)


def test_odd_pages_and_least_size(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 100_000)
    df = spark.createDataFrame(ODD, "page_id long, url string, html string").repartition(2)
    for least in (0, 4, 5):
        assert rows(warc.read_archives(warc.write_archives(df, min_bytes=least))) == brute(ODD, least)
    payloads = {r["page_id"]: r["payload"] for r in warc.read_archives(warc.write_archives(df)).collect() if r["payload"] is not None}
    assert payloads[6] == ("é" * 300000).encode() and 1 not in payloads
    assert warc.read_archives(warc.write_archives(df.filter("page_id > 99"))).count() == 0


def test_records_are_frames_of_their_own_with_the_dictionary(spark, tmp_path):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    manifest = warc.write_archives(pages, folder=f"file://{tmp_path}").collect()
    assert sum(r["records"] for r in manifest) == pages.count()
    raw = open(manifest[0]["path"].removeprefix("file://"), "rb").read()
    assert int.from_bytes(raw[:4], "little") == warc.DICT_MAGIC
    size = int.from_bytes(raw[4:8], "little")
    assert zstandard.ZstdCompressionDict(raw[8:8 + size]).dict_id()
    frames = raw[8 + size:]
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8:8 + size]))
    n = 0
    while frames:
        one = d.decompressobj()
        assert one.decompress(frames).startswith(b"WARC/1.1")
        frames, n = one.unused_data, n + 1
    assert n == manifest[0]["records"] + 1  # and warcinfo
