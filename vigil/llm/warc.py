"""WARC archives, compressed record by record with a Zstandard dictionary that each archive carries in front.

``write_archives`` gives each task's records one archive file (a new one after ARCHIVE_BYTES of records). A dictionary
is trained on the archive's first records, up to SAMPLE_BYTES of them (this bound changes the size of the files alone),
and written as a leading skippable frame; then each record is one Zstandard frame that uses it. Few or small records
train no dictionary; then the samples themselves are the dictionary. Files go to a folder that all machines share, in a
new file for each attempt of a task; the returned manifest lists the files of the attempts that counted, so a lost
executor leaves at most a file that nobody reads. ``read_archives`` reads the files of a manifest, an archive a task,
and checks the payload digest of every response.

Of pages with equal payloads of at least ``min_bytes`` bytes, that with the largest page_id becomes a response record,
the others revisit records that refer to it and hold no payload. Null html is the empty payload. A null page_id counts
as smaller than all others. Rows that repeat page_id and html get the same type of record. Control characters of a url
are percent-encoded. A table without rows gives no archive. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import urllib.parse
import uuid

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import cut_batch, scratch_root, written

ARCHIVE_BYTES = 256_000_000
SAMPLE_BYTES, DICT_BYTES, LEVEL = 2_000_000, 32_768, 3
#: Magic number of the dictionary's skippable frame, and the profile of revisits by digest.
DICT_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Pages carry no time of their own; a fixed one keeps archives reproducible.
DATE = "1970-01-01T00:00:00Z"
NULL_ID = -(2**63)
READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri) if ":" in uri else f"file://{uri}")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, record_id: str, fields: dict[str, str], block: bytes) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": DATE, **fields, "Content-Length": str(len(block))}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + block + b"\r\n\r\n"


def page_urn(page_id: int | None) -> str:
    return f"urn:x-page:{'null' if page_id is None else page_id}"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A response record with its payload, or a revisit record with the headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = urllib.parse.quote(url, safe="".join(map(chr, range(33, 127)))) if url else page_urn(page_id)
    fields = {"WARC-Target-URI": target, "WARC-Payload-Digest": f"sha1:{sha1_base32(payload)}", "Content-Type": "application/http; msgtype=response"}
    if revisit:
        return record("revisit", page_urn(page_id), {**fields, "WARC-Profile": PROFILE, "WARC-Refers-To": f"<{page_urn(refers_to)}>"}, http)
    return record("response", page_urn(page_id), fields, http + payload)


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, k=512, d=8, level=LEVEL)
    except (zstandard.ZstdError, ValueError):
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICT_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Archive:
    """One file: dictionary frame, then a frame for each record. The first records are held until they train the dictionary."""

    def __init__(self, fs: pa.fs.FileSystem, path: str):
        self.out, self.path = fs.open_output_stream(path, compression=None), path
        self.held, self.size, self.records, self.compress = [], 0, 0, None

    def add(self, rec: bytes) -> None:
        self.size += len(rec)
        self.records += 1
        if self.compress:
            self.out.write(self.compress(rec))
        else:
            self.held.append(rec)
            if self.size >= SAMPLE_BYTES:
                self.start()

    def start(self) -> None:
        d = dictionary(self.held)
        raw = d.as_bytes()
        self.out.write(struct.pack("<II", DICT_MAGIC, len(raw)) + raw)
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=d).compress
        self.out.write(self.compress(record("warcinfo", f"urn:uuid:{uuid.uuid4()}", {"Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")))
        for rec in self.held:
            self.out.write(self.compress(rec))
        self.held = []

    def close(self) -> None:
        if not self.compress:
            self.start()
        self.out.close()


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write all rows; returns the manifest (path, records). ``folder``: shared; the checkpoint folder, if not given."""
    spark = pages.sparkSession
    folder = folder or f"{scratch_root(spark)}/warc-{uuid.uuid4().hex}"
    fs, path = filesystem(folder)
    fs.create_dir(path)
    rows = pages.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    ids = rows.filter(F.octet_length("html") >= min_bytes).select("id", "sha1").distinct()
    last = ids.groupBy("sha1").agg(F.max("id").alias("refers_to"))
    revisits = ids.join(last, "sha1").filter("id <> refers_to")
    typed = rows.join(revisits.select("id", "sha1", "refers_to"), ["id", "sha1"], "left").select("id", "url", "html", "refers_to")

    def write(batches):
        fs, path = filesystem(folder)
        archive, done = None, []
        for batch in batches:
            for part in cut_batch(batch, ["html"]):
                for i, u, h, r in zip(*(part.column(c).to_pylist() for c in range(4))):
                    if archive is None:
                        archive = Archive(fs, f"{path}/{uuid.uuid4().hex}.warc.zst")
                    own = lambda x: None if x == NULL_ID else x
                    archive.add(page_record(own(i), u, h.encode(), own(r), r is not None))
                    if archive.size >= ARCHIVE_BYTES:
                        archive.close()
                        done.append(archive)
                        archive = None
        if archive:
            archive.close()
            done.append(archive)
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{a.path.rsplit('/', 1)[1]}" for a in done], pa.string()), pa.array([a.records for a in done], pa.int64())], names=["path", "records"])

    return written(typed.mapInArrow(write, "path string, records long"))


def read_records(uri: str):
    """The records of an archive, one at a time: (header fields, block)."""
    fs, path = filesystem(uri)
    with fs.open_input_stream(path, compression=None) as f:
        magic, size = struct.unpack("<II", f.read(8))
        if magic != DICT_MAGIC:
            raise ValueError(f"{uri}: no dictionary frame in front")
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(f.read(size))).stream_reader(f, read_across_frames=True)
        text = io.BufferedReader(reader, 1 << 20)
        while line := text.readline():
            if line.rstrip() != b"WARC/1.1":
                raise ValueError(f"{uri}: no record where one should begin")
            fields = {}
            while (line := text.readline().rstrip(b"\r\n")):
                name, _, value = line.decode().partition(": ")
                fields[name] = value
            block = text.read(int(fields["Content-Length"]))
            if text.read(4) != b"\r\n\r\n":
                raise ValueError(f"{uri}: a record does not end where it should")
            yield fields, block


def page_of(urn: str) -> int | None:
    name = urn.strip("<>").rsplit(":", 1)[1]
    return None if name == "null" else int(name)


def read_archives(manifest: DataFrame) -> DataFrame:
    """The page records of the manifest's archives, with payloads (null for revisits)."""
    n = manifest.count()
    names = [c.split()[0] for c in READ.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def read(batches):
        rows, size = [], 0
        out = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                for fields, block in read_records(uri):
                    kind = fields["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    stated = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and (sha1_base32(payload) != digest or len(payload) != stated):
                        raise ValueError(f"{uri}: a payload is not what its record states")
                    rows.append((page_of(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], stated, digest, kind, page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None, payload if kind == "response" else None))
                    size += len(payload)
                    if size > 4_000_000 or len(rows) > 5000:
                        yield out()
                        rows, size = [], 0
        if rows:
            yield out()

    return manifest.select("path").repartition(max(n, 1)).mapInArrow(read, READ)
