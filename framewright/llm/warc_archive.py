"""WARC archives in Zstandard with a dictionary: one frame a record, written and read back.

Layout of a file: a skippable frame (magic 0x184D2A5D, little-endian length) that holds the
dictionary, itself a Zstandard frame; then one frame for each record, its size in the header.

Writing: payload digests are SHA-256.  Of equal payloads of at least ``LEAST_REVISIT`` bytes,
the record with the smallest page_id is the response and the others revisit it.  The first
ids are found by a grouped minimum over digests that occur more than once (partial sums first,
so a hot digest is one row a task) and joined back; adaptive execution splits a hot digest.
Each task then streams one file, with a dictionary trained on its first records (at
most ``SAMPLE_BYTES``; this changes sizes only).  Files are named by the task attempt and listed in
a manifest, so files of lost attempts are never read.

Reading streams a file frame by frame and checks what it meets: frame magic and type, the
declared frame size, that a frame is exactly one record, version line, required headers,
Content-Length, the two closing line ends, and the digest of every response's payload.

Null html counts as empty.  Rows of one payload that share the smallest page_id are all
responses.  A null page_id is never the smallest unless all are null (then all are responses).
Other columns than page_id, url and html are not read; a null url gives an empty target.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.storage import file_uri, materialize, new_path, open_in, open_out, table

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_REVISIT = 100
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 32 << 10
READ_BYTES = 1 << 20
DATE = "2024-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def plan_records(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest and refers_to (null for responses)."""
    pages = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha2("html", 256)})
    large = pages.where(F.col("payload_bytes") >= LEAST_REVISIT)
    again = large.groupBy("payload_digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first_id")).where("n > 1")
    first = materialize(again.select("payload_digest", "first_id"), "first-pages")
    return pages.join(first, "payload_digest", "left").withColumn("refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id")), F.col("first_id")))


def record_id(page_id: object) -> str:
    """A null id and an empty one differ; what a header can't hold is percent-encoded."""
    return "<urn:framewright:no-page>" if page_id is None else f"<urn:framewright:page:{quote(str(page_id), safe='')}>"


def record_bytes(row: dict) -> bytes:
    """One WARC record."""
    revisit = row["refers_to"] is not None
    block = HTTP_HEAD if revisit else HTTP_HEAD + row["html"].encode()
    url = "".join(c for c in row["url"] if c not in "\r\n")
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(row["page_id"])),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("WARC-Payload-Length", str(row["payload_bytes"])),
        *([("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(row["refers_to"]))] if revisit else []),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return b"".join([VERSION, b"\r\n", *(f"{k}: {v}\r\n".encode() for k, v in head), b"\r\n", block, b"\r\n\r\n"])


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for records like the samples; empty if they are too few or too small."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


class ArchiveWriter:
    def __init__(self, out: pa.NativeFile):
        self.out, self.held, self.n_held, self.pack = out, [], 0, None

    def add(self, record: bytes) -> None:
        if self.pack is not None:
            self.out.write(self.pack.compress(record))
            return
        self.held.append(record)
        self.n_held += len(record)
        if self.n_held >= SAMPLE_BYTES:
            self._start()

    def _start(self) -> None:
        dictionary = train_dictionary([r[: SAMPLE_BYTES // 8] for r in self.held])
        frame = zstandard.ZstdCompressor(level=10).compress(dictionary) if dictionary else b""
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(frame)) + frame)
        self.pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_content_size=True)
        for r in self.held:
            self.out.write(self.pack.compress(r))
        self.held = []

    def close(self) -> None:
        if self.pack is None:
            self._start()
        self.out.close()


def write_archives(pages: DataFrame) -> DataFrame:
    """Writes the pages as archives and returns their manifest: path and n_records."""
    folder = file_uri(new_path(pages.sparkSession, "warc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, n, path = None, 0, ""
        for batch in batches:
            for i in range(batch.num_rows):
                if writer is None:
                    path = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
                    writer = ArchiveWriter(open_out(path))
                writer.add(record_bytes(batch.slice(i, 1).to_pylist()[0]))
                n += 1
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n])], ["path", "n_records"])

    columns = ["page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to"]
    return materialize(plan_records(pages).select(*columns).mapInArrow(run, "path string, n_records long"), "warc-manifest")


def frames(file: pa.NativeFile) -> Iterator[bytes]:
    """The content of each frame behind the leading dictionary frame."""
    magic, size = struct.unpack("<II", _exactly(file, 8))
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("no leading skippable frame")
    data = _exactly(file, size)
    if data[:4] == struct.pack("<I", FRAME_MAGIC):
        data = zstandard.ZstdDecompressor().decompress(data)
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data) if data else None)
    rest = b""
    while rest := rest or file.read(READ_BYTES):
        while len(rest) < 18 and (more := file.read(READ_BYTES)):
            rest += more
        if rest[:4] != struct.pack("<I", FRAME_MAGIC):
            raise ValueError("not a Zstandard frame")
        declared = zstandard.get_frame_parameters(rest).content_size
        one, parts = unpack.decompressobj(), []
        parts.append(one.decompress(rest))
        while not one.eof:
            more = file.read(READ_BYTES)
            if not more:
                raise ValueError("the archive ends inside a frame")
            parts.append(one.decompress(more))
        rest = one.unused_data
        content = b"".join(parts)
        if declared != len(content):
            raise ValueError("a frame's declared size is wrong")
        yield content


def _exactly(file: pa.NativeFile, n: int) -> bytes:
    data = file.read(n)
    if len(data) != n:
        raise ValueError("the archive is cut short")
    return data


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and payload of a frame that holds exactly one record."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise ValueError("no version line or no end of the headers")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        key = name.decode("ascii").lower()
        if not colon or not key or key in headers:
            raise ValueError(f"bad or repeated header {name!r}")
        headers[key] = value.strip().decode()
    for key in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if not headers.get(key):
            raise ValueError(f"no {key}")
    if headers["warc-type"] not in ("response", "revisit"):
        raise ValueError("unknown record type")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("Content-Length doesn't match the frame")
    _, gap, payload = rest[:n].partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no end of the HTTP headers")
    if headers["warc-type"] == "response":
        if headers["warc-payload-digest"] != f"sha256:{hashlib.sha256(payload).hexdigest()}" or headers["warc-payload-length"] != str(len(payload)):
            raise ValueError("the payload's digest or length is wrong")
    elif payload or not headers.get("warc-refers-to"):
        raise ValueError("a revisit has a payload or refers to nothing")
    return headers, payload


def _page(urn: str) -> str | None:
    return None if urn == record_id(None) else unquote(urn.removeprefix(record_id("")[:-1]).removesuffix(">"))


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """page_id (text), target, record_type, payload_bytes, payload_digest, refers_to (text) of every
    record, and ``payload`` if asked for (null for revisits)."""
    n_files = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, rows, held = 0, [], 0
                with open_in(row["path"]) as file:
                    for record in frames(file):
                        h, payload = parse_record(record)
                        response = h["warc-type"] == "response"
                        rows.append((_page(h["warc-record-id"]), h.get("warc-target-uri", ""), h["warc-type"], int(h["warc-payload-length"]), h["warc-payload-digest"].removeprefix("sha256:"), None if response else _page(h["warc-refers-to"]), *([payload if response else None] if payloads else [])))
                        n, held = n + 1, held + len(payload) * payloads
                        if len(rows) >= 5000 or held >= 8 << 20:
                            yield _records(rows, payloads)
                            rows, held = [], 0
                if n != row["n_records"]:
                    raise ValueError(f"{row['path']} has {n} records instead of {row['n_records']}")
                if rows:
                    yield _records(rows, payloads)

    schema = "page_id string, target string, record_type string, payload_bytes long, payload_digest string, refers_to string" + ", payload binary" * payloads
    return manifest.select("path", "n_records").repartition(n_files).mapInArrow(run, schema)


def _records(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    names = ["page_id", "target", "record_type", "payload_bytes", "payload_digest", "refers_to", *["payload"] * payloads]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)], names)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    read = read_archives(write_archives(pages))
    return read.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
