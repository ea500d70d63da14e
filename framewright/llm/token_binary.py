"""Token ids as binary files: byte or bit planes, each compressed, behind a chunk index.

Writing: documents are range partitioned and sorted by doc_id; each task encodes its texts
and streams one file.  A file is a sequence of blocks of ``BLOCK`` ids (the last one
shorter).  A block of unsigned 32-bit ids is transposed into four byte planes, or
into 32 bit planes, and each plane is a zstandard frame of its own.  The footer holds the
index (where each block starts, the size of each plane, the CRC-32 of the ids) and the
documents (doc_id, n_tokens), so a reader can open any block alone.  Files are named
by the task attempt; only files in the manifest count, so a lost executor leaves at most a
file that nobody reads.

Reading: the manifest has one row for each file; running sums over it give the ids before each
file, and every file is read by itself, block by block.

Words are encoded once per task and remembered (:class:`WordMemory`): the
tokenizer never joins anything across white space that follows another character than white space,
nor across a full stop or comma that follows a letter, so texts are cut there, on the bytes of a whole block.
The different words of a block are found by Arrow, so only these are looked up.

Null and empty texts hold the end id only.  Rows without a doc_id come first.  Rows of
one doc_id are ordered by where they were read, then by text, and may lie in different files.
Columns other than doc_id and text are not read; an empty table gives no file.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright.llm import words as W
from framewright.llm.ragged import WordMemory, offsets
from framewright.storage import file_uri, materialize, new_path, open_in, open_out, table

BLOCK = 1 << 16
MAGIC = b"FWTOKPL1"
END_ID = 2

#: Bytes of text, and pieces of it, that are encoded together.
ENCODED_BYTES, ENCODED_PIECES = 1 << 22, 1 << 20

_CUT = re.compile(r"(?<=\S)(?= )")
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123)]] = True
# Last and last but one bytes of all white space beyond ASCII, and of some other characters.
_WIDE_LAST, _WIDE_BEFORE = np.zeros(256, bool), np.zeros(256, bool)
_WIDE_LAST[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_WIDE_BEFORE[[0xC2, 0x9A, 0x80, 0x81]] = True


def cuts(data: np.ndarray, pattern: bool = True) -> np.ndarray:
    """Places in UTF-8 bytes before which pieces that are encoded apart may begin: at a space after a visible
    character; under ``PATTERN`` also at other white space, and at a full stop or comma after a letter."""
    before, here = data[:-1], data[1:]
    hit = here == 32
    if pattern:
        hit |= here - np.uint8(9) < 5
    hit &= before > 32
    if pattern:
        hit |= ((here == 44) | (here == 46)) & _IS_LETTER[before]
    at = np.flatnonzero(hit) + 1
    wide = np.flatnonzero(data[at - 1] >= 128)
    ends = at[wide]
    return np.delete(at, wide[_WIDE_LAST[data[ends - 1]] & _WIDE_BEFORE[data[ends - 2]]])


# The pre-tokenisation pattern of byte-level BPE, and the bytes that its alphabet shows as themselves.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHOWN = (*range(33, 127), *range(161, 173), *range(174, 256))
# The same on words with white space at their beginning only, one character; without looking ahead it is matched faster.
PLAIN_PATTERN = PATTERN.replace(r"|\s+(?!\S)", "")


def is_plain(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which words (bytes at[k] to at[k+1], none empty) are one ASCII white space and then visible characters below U+0240, without
    the beginning of a special token.  Such words can be encoded one after the other as one text."""
    odd = (data > 0xC8) | (data <= 32)
    first = data[at[:-1]]
    odd[at[:-1]] = (first != 32) & (first - np.uint8(9) >= 5)
    this, following = data[:-1], data[1:]
    odd[:-1] |= (this == 60) & (following == 124) | (this == 0xC2) & ((following == 0x85) | (following == 0xA0))
    return ~np.logical_or.reduceat(odd, at[:-1]) & (np.diff(at) > 1)


def byte_ranks(model: dict) -> dict[bytes, int] | None:
    """Merge ranks of a tokenizer's model whose ids are in the order of its merges, else None."""
    hidden = [b for b in range(256) if b not in SHOWN]
    byte = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(hidden)}
    merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merged)):
        return None
    return {bytes(map(byte.__getitem__, token)): i for token, i in model["vocab"].items() if i < 256 + len(merged)}


@lru_cache(maxsize=2)
def word_memory(path: str) -> tuple[WordMemory, bool]:
    """Ids of words in UTF-8, and whether the tokenizer parts texts by ``PATTERN``.  New words in Latin letters
    without a special token are then encoded together by a faster library from the same merges; all others by the tokenizer itself."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    parted = file["pre_tokenizer"] or {}
    pattern = parted.get("type") == "ByteLevel" and parted.get("use_regex", True) and not parted.get("add_prefix_space", True) and not file.get("normalizer")
    pattern = pattern and all(re.fullmatch(r"<\|[^\s.,]+", t["content"]) for t in file["added_tokens"])
    tokenizer, ranks = Tokenizer.from_file(path), byte_ranks(file["model"]) if pattern else None
    fast = tiktoken.Encoding("merges", pat_str=PLAIN_PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranks else None
    # every byte of a text lies in one token, so the tokens of words encoded together part at the words' bytes
    n_bytes = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, i in tokenizer.get_vocab().items():
        n_bytes[i] = len(token)

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        length = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        together = is_plain(data, offsets(length)) if fast else np.zeros(len(words), bool)
        ids = np.array(fast.encode_ordinary(data[np.repeat(together, length)].tobytes().decode()) if together.any() else [], np.uint32)
        sizes = np.zeros(len(words), np.int64)
        sizes[together] = np.diff(np.searchsorted(offsets(n_bytes[ids]), offsets(length[together])))
        alone = [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast([w.decode() for w in compress(words, ~together)], add_special_tokens=False)]
        sizes[~together] = list(map(len, alone))
        out, at = np.zeros(sizes.sum(), np.uint32), np.repeat(together, sizes)
        out[at] = ids
        out[~at] = np.concatenate([np.zeros(0, np.uint32), *alone])
        return out, sizes

    return WordMemory(encode), pattern


def encode(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each with the end id, and the number of each text's ids; null texts are empty."""
    memory, pattern = word_memory(path)
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, at, data = texts.buffers()
    begins = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[begins[0] : begins[-1]]
    begins = begins - begins[0]
    edge = np.zeros(len(data) + 1, bool)
    edge[cuts(data, pattern)] = True
    edge[begins] = True
    edge = np.flatnonzero(edge)
    parts, ends, n = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)], 0
    for k in range(0, len(edge) - 1, ENCODED_PIECES):
        own = edge[k : k + ENCODED_PIECES + 1]
        words = pa.Array.from_buffers(pa.large_binary(), len(own) - 1, [None, pa.py_buffer(own), pa.py_buffer(data)]).dictionary_encode()
        ids, at = memory.lookup_distinct(words.dictionary.to_pylist(), words.indices.to_numpy())
        parts.append(ids)
        ends.append(n + at[1:])
        n += len(ids)
    ends = np.concatenate(ends)[np.searchsorted(edge, begins[1:])]
    return np.insert(np.concatenate(parts), ends, end_id).astype("<u4"), np.diff(ends, prepend=0) + 1


def split_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [p.tobytes() for p in np.ascontiguousarray(rows.T)]
    return [np.packbits(p).tobytes() for p in np.unpackbits(rows, axis=1, bitorder="little").T]


def join_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if not bits:
        return np.ascontiguousarray(np.stack([np.frombuffer(p, np.uint8) for p in planes], 1)).view("<u4").reshape(-1)
    rows = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes], 1)
    return np.packbits(rows, axis=1, bitorder="little").view("<u4").reshape(-1)


class PlaneWriter:
    """Writes one file, a block at a time."""

    def __init__(self, out: pa.NativeFile, doc_type: pa.DataType, bits: bool = False):
        self.out, self.bits, self.doc_type = out, bits, doc_type
        self.pack = zstandard.ZstdCompressor(level=3)
        self.held, self.n_held, self.n_ids, self.at = [], 0, 0, len(MAGIC)
        self.index, self.docs = [], []
        out.write(MAGIC)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.docs.append(pa.record_batch([doc_ids.cast(self.doc_type), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens"]))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= BLOCK:
            held = np.concatenate(self.held)
            whole = len(held) // BLOCK * BLOCK
            for k in range(0, whole, BLOCK):
                self._block(held[k : k + BLOCK])
            self.held, self.n_held = [held[whole:]], len(held) - whole

    def _block(self, ids: np.ndarray) -> None:
        planes = [self.pack.compress(p) for p in split_planes(ids, self.bits)]
        self.out.write(b"".join(planes))
        self.index.append([self.at, len(ids), zlib.crc32(ids.tobytes()), [len(p) for p in planes]])
        self.at += sum(map(len, planes))

    def close(self) -> None:
        if self.n_held:
            self._block(np.concatenate(self.held))
        docs = pa.BufferOutputStream()
        with pa.ipc.new_stream(docs, pa.schema([("doc_id", self.doc_type), ("n_tokens", pa.int64())])) as w:
            for b in self.docs:
                w.write_batch(b)
        parts = [self.pack.compress(json.dumps({"bits": self.bits, "blocks": self.index}).encode()), self.pack.compress(docs.getvalue().to_pybytes())]
        tail = np.array([self.at, *map(len, parts)], "<u8").tobytes()
        self.out.write(b"".join([*parts, tail, MAGIC]))
        self.out.close()


class PlaneReader:
    """Reads one file: its documents, and any block by itself."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        size = file.size()
        tail = file.read_at(32, size - 32)
        if file.read_at(8, 0) != MAGIC or tail[24:] != MAGIC:
            raise ValueError("not a token file, or cut short")
        at, n_index, n_docs = np.frombuffer(tail[:24], "<u8").tolist()
        if at + n_index + n_docs + 32 != size:
            raise ValueError("the footer's lengths don't match the file")
        self.unpack = zstandard.ZstdDecompressor()
        head = json.loads(self.unpack.decompress(file.read_at(n_index, at)))
        self.bits, self.index = head["bits"], head["blocks"]
        self.docs = pa.ipc.open_stream(self.unpack.decompress(file.read_at(n_docs, at + n_index))).read_all()

    def block(self, k: int) -> np.ndarray:
        at, n, crc, sizes = self.index[k]
        data, edge = self.file.read_at(sum(sizes), at), offsets(np.array(sizes)).tolist()
        ids = join_planes([self.unpack.decompress(data[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)], n, self.bits)
        if len(ids) != n or zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"block {k} is damaged")
        return ids

    def checksums(self) -> list[int]:
        """CRC-32 of the ids of each document."""
        out, crc = [], 0
        sizes = self.docs.column("n_tokens").to_pylist()
        if not sizes:
            return out
        left = sizes[0]
        for k in range(len(self.index)):
            data, at = memoryview(self.block(k).tobytes()), 0
            while at < len(data):
                n = min(left * 4, len(data) - at)
                crc = zlib.crc32(data[at : at + n], crc)
                at, left = at + n, left - n // 4
                if not left:
                    out.append(crc)
                    crc, left = 0, sizes[len(out)] if len(out) < len(sizes) else 0
        return out


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, bits: bool = False) -> DataFrame:
    """Writes the files and returns their manifest: part, path, n_docs, n_tokens."""
    from pyspark.sql.pandas.types import to_arrow_type

    folder = file_uri(new_path(docs.sparkSession, "tokens"))
    doc_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, n_docs, path = None, 0, ""
        for batch in batches:
            for part in W.blocks(batch, "text", ENCODED_BYTES):
                if writer is None:
                    path = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tok"
                    writer = PlaneWriter(open_out(path), doc_type, bits)
                writer.add(part.column("doc_id"), *encode(part.column("text"), tokenizer_path, end_id))
                n_docs += part.num_rows
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([path]), pa.array([n_docs]), pa.array([writer.n_ids])], ["part", "path", "n_docs", "n_tokens"])

    placed = docs.select("doc_id", "text", F.spark_partition_id().alias("_from"))
    placed = placed.repartitionByRange(F.col("doc_id").asc_nulls_first(), "_from").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_from", "text")
    return materialize(placed.select("doc_id", "text").mapInArrow(run, "part int, path string, n_docs long, n_tokens long"), "token-manifest")


def read_token_files(manifest: DataFrame, doc_id_type: str = "long") -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files of a manifest."""
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("path", F.coalesce(before, F.lit(0)).cast("long").alias("start"))
    n_files = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_in(row["path"]) as file:
                    reader = PlaneReader(file)
                    sizes = reader.docs.column("n_tokens").to_numpy()
                    starts = row["start"] + offsets(sizes)[:-1]
                    whole = pa.table([reader.docs.column("doc_id"), pa.array(starts), pa.array(sizes), pa.array(reader.checksums(), pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                    yield from whole.combine_chunks().to_batches(max_chunksize=10_000)

    return files.repartition(n_files).mapInArrow(run, f"doc_id {doc_id_type}, start long, n_tokens long, ids_crc32 long")


def tokenizer_file() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op9_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return read_token_files(write_token_files(docs, tokenizer_file()), docs.schema["doc_id"].dataType.simpleString())
