"""Removal of word sequences that occur more than once in a corpus.

A window is ``width`` consecutive words of one document.  Every word covered by
a window that also starts anywhere else, in the same document or another, goes.

1. Documents are packed into chunks of text, written once as a table bucketed by chunk: both
   passes read the very same chunks.
2. Each chunk sends its distinct window hashes (Rabin-Karp) by buckets: one row per chunk and
   bucket, 8 bytes a window.  One polynomial hash chooses the bucket and two others are the 8
   bytes, so that 62 bits and those of the bucket tell windows apart: more bits the more windows
   there are (86 at 10**13).  A hash that the chunk holds twice is marked, so a window that fills a
   third of the corpus still is one entry for each chunk.
3. A bucket counts its hashes and answers each chunk with one bit a hash.
4. The answers meet the chunks where these lie (the table's buckets save the shuffle
   of the texts); repeated windows merge into maximal intervals and the words inside go.

Null and empty texts have no words and come back as empty texts; texts shorter than
a window lose nothing.  Repeated rows are documents of their own, so both lose what they
share.  Equal ids are kept apart.  Columns other than doc_id and text are not read.
The sizes of chunks and buckets follow the corpus (:func:`sizes`), so that a row carries many hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import words as W
from framewright.storage import new_path, table

WIDTH = 35
#: Bytes of text in a chunk and hashes in a bucket: at first, and at most (a task holds one of them).
CHUNK_BYTES, MOST_CHUNK = 4 << 20, 32 << 20
BUCKET_HASHES, MOST_BUCKET = 1 << 19, 1 << 23
ROW_HASHES = 64
LEAST_BUCKETS = 64

_INTERVALS = "array<struct<first:int,last:int>>"


def sizes(total: int) -> tuple[int, int]:
    """Bytes in a chunk and hashes in a bucket for so many bytes of text: a row, one chunk's hashes
    of one bucket, has about ``ROW_HASHES`` as long as both stay in their bounds (up to 4 TB)."""
    chunk, bucket = CHUNK_BYTES, BUCKET_HASHES
    while chunk * bucket < ROW_HASHES * total and (chunk < MOST_CHUNK or bucket < MOST_BUCKET):
        chunk, bucket = min(2 * chunk, MOST_CHUNK), min(2 * bucket, MOST_BUCKET)
    return chunk, bucket


def _packer(chunk_bytes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.blocks(batch, "text", chunk_bytes):
                texts = [t or "" for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().int >> 65]), pa.array([sum(len(t.encode().split()) for t in texts)]), pa.array([part.column("doc_id").to_pylist()], pa.list_(part.schema.field("doc_id").type)), pa.array([texts])],
                    ["chunk", "n_words", "doc_ids", "texts"],
                )

    return pack


def pack_chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The documents as rows of (chunk, n_words, doc_ids, texts), in files bucketed by chunk."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    name = f"framewright_chunks_{uuid.uuid4().hex}"
    chunks = docs.select("doc_id", "text").mapInArrow(_packer(chunk_bytes), f"chunk long, n_words long, doc_ids array<{kind}>, texts array<string>")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks.write.bucketBy(buckets, "chunk").option("path", new_path(spark, name)).saveAsTable(name)
    chunks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, they are not the catalog's; it was only needed to bucket them
    return chunks


@dataclass
class Windows:
    """The windows of a chunk's texts."""

    word_at: np.ndarray  #: words before each document (n+1)
    first: np.ndarray  #: first word of each window
    place: np.ndarray  #: where each window's hash is among the distinct ones
    distinct: np.ndarray  #: the distinct hashes, by bucket
    twice: np.ndarray  #: which of them occur twice here
    buckets: np.ndarray  #: the buckets that have any
    edges: np.ndarray  #: where those begin, and the end


def chunk_windows(texts: list[str], width: int, bits: int) -> Windows:
    buf, at = W.text_bytes([t.encode() for t in texts])
    starts, _, words = W.word_digests(buf)
    word_at = np.searchsorted(starts, at)
    hashes, other = W.window_hashes(words, width)
    owner = np.repeat(np.arange(len(texts)), np.diff(word_at))
    first = np.flatnonzero(owner[: len(hashes)] == owner[width - 1 :]) if len(hashes) else np.zeros(0, np.int64)
    hashes, bucket = hashes[first], (other[first] >> np.uint64(31 - bits)).astype(np.int32)
    order = np.lexsort((hashes, bucket))
    hashes, bucket = hashes[order], bucket[order]
    new = np.ones(len(order), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (bucket[1:] != bucket[:-1])
    begin = np.flatnonzero(new)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    edges = np.flatnonzero(np.diff(bucket[begin], prepend=-1))
    return Windows(word_at, first, place, hashes[begin], np.diff(np.append(begin, len(order))) > 1, bucket[begin][edges], np.append(edges, len(begin)))


def _sender(width: int, bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, texts in zip(batch.column("chunk").to_pylist(), batch.column("texts"), strict=True):
                w = chunk_windows(texts.as_py(), width, bits)
                spans = [slice(a, b) for a, b in zip(w.edges[:-1], w.edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w.buckets), pa.array(np.full(len(spans), chunk)), pa.array([w.distinct[s].tobytes() for s in spans], pa.binary()), pa.array([np.packbits(w.twice[s]).tobytes() for s in spans], pa.binary())],
                    ["bucket", "chunk", "hashes", "twice"],
                )

    return send


def _count(bucket: pa.Table) -> pa.Table:
    """For each chunk, one bit a hash: does its window start more than once in the corpus?"""
    parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in bucket.column("hashes")]
    sizes = np.array([len(p) for p in parts])
    twice = np.concatenate([np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=n) for x, n in zip(bucket.column("twice"), sizes, strict=True)])
    _, place, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    repeated = times > 1
    repeated[place[twice.astype(bool)]] = True
    answers = np.split(repeated[place], np.cumsum(sizes)[:-1])
    return pa.table({"chunk": bucket.column("chunk"), "bucket": bucket.column("bucket"), "repeated": pa.array([np.packbits(a).tobytes() for a in answers], pa.binary())})


def intervals(gone: np.ndarray) -> list[dict[str, int]]:
    """Maximal runs of marked words, ends exclusive."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    return [{"first": a, "last": b} for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True)]


def _remover(width: int, bits: int, doc_type: pa.DataType):
    def remove(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        by_bucket = dict(zip(answers.column("bucket").to_pylist(), answers.column("repeated"), strict=True))
        ids, kept, n_words, n_removed, removed = [], [], [], [], []
        for row in chunks.select(["doc_ids", "texts"]).to_pylist():
            w = chunk_windows(row["texts"], width, bits)
            flags = [np.unpackbits(np.frombuffer(by_bucket[b].as_buffer(), np.uint8), count=n) for b, n in zip(w.buckets.tolist(), np.diff(w.edges).tolist(), strict=True)]
            hit = np.zeros(w.word_at[-1], bool)
            if flags:
                hit[w.first[np.concatenate(flags).astype(bool)[w.place]]] = True
            gone = W.covered(hit, width, len(hit))
            for i, text in enumerate(row["texts"]):
                own = gone[w.word_at[i] : w.word_at[i + 1]]
                split = text.encode().split()
                n_words.append(len(split))
                n_removed.append(int(own.sum()))
                removed.append(intervals(own))
                kept.append(b" ".join(compress(split, (~own).tolist()) if n_removed[-1] else split).decode())
            ids += row["doc_ids"]
        schema = pa.schema([("doc_id", doc_type), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("removed", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))])
        return pa.table([pa.array(ids, doc_type), n_words, n_removed, kept, pa.array(removed, schema.field("removed").type)], schema=schema)

    return remove


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space) and ``removed``,
    the maximal intervals of removed words."""
    chunk_bytes, bucket_hashes = sizes(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    chunks = pack_chunks(docs, chunk_bytes)
    total = chunks.agg(F.sum("n_words")).first()[0] or 0
    bits = (max(LEAST_BUCKETS, -(-total // bucket_hashes)) - 1).bit_length()
    hashes = chunks.select("chunk", "texts").mapInArrow(_sender(width, bits), "bucket int, chunk long, hashes binary, twice binary")
    answers = hashes.groupBy("bucket").applyInArrow(_count, "chunk long, bucket int, repeated binary")
    kind = docs.schema["doc_id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    remove = _remover(width, bits, to_arrow_type(docs.schema["doc_id"].dataType))
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(remove, f"doc_id {kind}, n_words long, n_removed long, kept_text string, removed {_INTERVALS}")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


_WORD = r"[^\x20\x09-\x0D]+"
ORACLE = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
g AS (SELECT r, i, md5(array_to_string(w[i:i + {WIDTH - 1}], ' ')) AS h
      FROM (SELECT r, w, unnest(generate_series(1, len(w) - {WIDTH - 1})) AS i FROM d)),
rep AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY h) > 1),
gone AS (SELECT DISTINCT r, i + k AS p FROM rep, (SELECT unnest(generate_series(0, {WIDTH - 1})) AS k)),
lost AS (SELECT r, list(p) AS ps FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN lost ON d.r = lost.r
"""
