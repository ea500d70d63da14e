"""SentencePiece encoding that keeps track of source bytes, and decoding.

1. Normalisation walks the text by longest prefix through the compiled character map of
   the model (a double-array trie over UTF-8 bytes, followed by the replacements) and
   records, for every normalised character, the source byte where it came from.  A model
   without a map leaves characters as they are; spaces become U+2581 and the dummy
   prefix stands at source byte 0.
2. No piece of the vocabulary may hold a U+2581 after another character (this is checked),
   so words can be merged apart from each other.  Byte-pair merging runs on all new words
   of a block at once, best score first and leftmost on ties; words of over ``LONG_WORD``
   characters take a heap of pairs instead, so that time stays near-linear in their length.  A
   bounded memory holds words seen before.  Characters without a piece become byte pieces.
3. Each piece projects through the record to its span of source bytes; byte pieces take
   one byte each.

Null texts count as empty: begin and end id only, decoded to the empty text.  Repeated
rows are encoded row by row, no column but doc_id and text is read, and texts of any length
are worked on whole, a block of about 1 MB at a time.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from framewright.llm import words as W
from framewright.llm.ragged import WordMemory, gather, offsets
from framewright.storage import table

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
LONG_WORD = 128


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol buffer message."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            shift += 7
            i += 1
            if data[i - 1] < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        if key & 7 == 0:
            value, i = varint(i)
        else:
            n, i = {5: (4, i), 1: (8, i)}.get(key & 7) or varint(i)
            value, i = data[i : i + n], i + n
        yield key >> 3, value


class CharacterMap:
    """Longest-prefix replacement through a compiled map: a length, a double-array trie
    of 32-bit units, and replacements that end in a zero byte."""

    def __init__(self, compiled: bytes):
        n = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled[4 : 4 + n], "<u4").tolist()
        self.replacements = compiled[4 + n :]

    def longest(self, data: bytes, i: int) -> tuple[int, bytes] | None:
        """Bytes consumed at ``i`` and what replaces them."""
        units, best = self.units, None
        if not units:
            return None
        step = lambda u: (u >> 10) << ((u & (1 << 9)) >> 6)
        at = step(units[0])
        for j in range(i, len(data)):
            at ^= data[j]
            unit = units[at]
            if unit & ((1 << 31) | 255) != data[j]:
                break
            at ^= step(unit)
            if (unit >> 8) & 1:
                where = units[at] & ((1 << 31) - 1)
                best = (j + 1 - i, self.replacements[where : self.replacements.index(0, where)])
        return best

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its characters and the end, the source byte."""
        data = text.encode()
        if not self.units:
            return text, char_starts(text, data)
        out, source, i = [], [], 0
        while i < len(data):
            hit = self.longest(data, i)
            if hit is None:
                n = 1
                while i + n < len(data) and data[i + n] & 0xC0 == 0x80:
                    n += 1
                hit = (n, data[i : i + n])
            new = hit[1].decode()
            out.append(new)
            source += [i] * len(new)
            i += hit[0]
        return "".join(out), np.array([*source, len(data)], np.int64)


def char_starts(text: str, data: bytes) -> np.ndarray:
    """The byte where each character starts, and the end."""
    if len(text) == len(data):
        return np.arange(len(data) + 1)
    return np.append(np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80), len(data))


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        scores, self.types = [], []
        norm = trainer = {}
        for key, value in _fields(model):
            if key == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0])
                self.types.append(piece.get(3, NORMAL))
            elif key == 2:
                trainer = dict(_fields(value))
            elif key == 3:
                norm = dict(_fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("the model is not of the BPE type")
        self.char_map = CharacterMap(norm.get(2, b""))
        self.dummy_prefix, self.trim, self.escape = norm.get(3, 1), norm.get(4, 1), norm.get(5, 1)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.begin, self.end, self.unknown = trainer.get(41, 1), trainer.get(42, 2), self.types.index(UNKNOWN)
        self.byte_id = np.full(256, self.unknown, np.int64)
        for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)):
            if t == BYTE:
                self.byte_id[int(p[3:5], 16)] = i
        self._merges(np.array(scores))
        self._surfaces()
        self.words = WordMemory(self.encode_words)
        apart = all(SPACE not in p.lstrip(SPACE) for p in self.symbol)
        self.word = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if apart else "(?s:.+)")

    def _merges(self, scores: np.ndarray) -> None:
        """Every pair of symbols that joins to a piece: its key, the piece and the order."""
        self.symbol = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t in (NORMAL, USER_DEFINED)}
        order = np.unique(-scores, return_inverse=True)[1]
        pairs = sorted((self.symbol[p[:k]] << 32 | self.symbol[p[k:]], i) for p, i in self.symbol.items() for k in range(1, len(p)) if p[:k] in self.symbol and p[k:] in self.symbol)
        self.pair = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.joined = np.array([i for _, i in pairs] or [0], np.int64)
        self.no_order = int(order.max()) + 1
        self.order = np.append(order[self.joined], self.no_order)
        chars = sorted((ord(p), i) for p, i in self.symbol.items() if len(p) == 1)
        self.char = np.array([c for c, _ in chars] or [0], np.int64)
        self.char_id = np.array([i for _, i in chars] or [0], np.int64)
        self.place: dict[int, int] | None = None

    def _surfaces(self) -> None:
        """What each id decodes to, as bytes."""
        out = [b"" if t == CONTROL else bytes([int(p[3:5], 16)]) if t == BYTE else " ⁇ ".encode() if t == UNKNOWN else p.replace(SPACE, " ").encode() for p, t in zip(self.pieces, self.types, strict=True)]
        self.surface = np.frombuffer(b"".join(out), np.uint8)
        self.surface_at = offsets(np.array([len(x) for x in out]))
        self.n_chars = np.array([len(p) for p in self.pieces])
        self.is_byte = np.array([t == BYTE for t in self.types])

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place in the table of each pair of symbols; the last place if it never joins."""
        key = np.where((left >= 0) & (right >= 0), left << 32 | right, -2)
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, at, len(self.pair))

    def _merge_long(self, sym: list[int], pair: list[int]) -> np.ndarray:
        """The symbols of one word after all merges, by a heap of its pairs and links between symbols."""
        if self.place is None:
            self.place = {k: i for i, k in enumerate(self.pair.tolist())}
        order, joined, none = self.order.tolist(), self.joined.tolist(), len(self.pair)
        n = len(sym)
        after, before, at = [*range(1, n), -1], list(range(-1, n - 1)), list(pair)
        heap = [(order[p], i) for i, p in enumerate(at) if p != none]
        heapify(heap)

        def renew(i: int) -> None:
            a, b = sym[i], sym[after[i]] if after[i] >= 0 else -1
            at[i] = self.place.get(a << 32 | b, none) if a >= 0 and b >= 0 else none
            if at[i] != none:
                heappush(heap, (order[at[i]], i))

        while heap:
            o, i = heappop(heap)
            if at[i] == none or order[at[i]] != o:
                continue  # one of its symbols has been joined since
            gone = after[i]
            sym[i], sym[gone], at[gone] = joined[at[i]], None, none
            after[i] = after[gone]
            if after[i] >= 0:
                before[after[i]] = i
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        return np.array([s for s in sym if s is not None], np.int64)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has.  Each round joins, in every word, its best
        pair: the highest score, leftmost among equals.  Symbols without a piece (below 0)
        never join.  Words with nothing to join leave the rounds."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        place = np.minimum(np.searchsorted(self.char, code), len(self.char) - 1)
        sym = np.where(self.char[place] == code, self.char_id[place], -1 - code)
        word, first = np.arange(len(words)), offsets(sizes)
        pair = self._pairs(sym, np.append(sym[1:], -1))
        pair[first[1:] - 1] = len(self.pair)
        done = []
        if len(long := np.flatnonzero(sizes > LONG_WORD)):
            for k in long.tolist():
                own = self._merge_long(sym[first[k] : first[k + 1]].tolist(), pair[first[k] : first[k + 1]].tolist())
                done.append((np.array([k]), own, np.array([0, len(own)])))
            rows = np.flatnonzero(sizes <= LONG_WORD)
            pair, _ = gather(pair, first, rows)
            sym, first = gather(sym, first, rows)
            word = word[rows]
        while len(word):
            low = np.minimum.reduceat(self.order[pair] << 32 | np.arange(len(pair)), first[:-1])
            live = low < self.no_order << 32
            if not live.all():
                rows = np.flatnonzero(~live)
                done.append((word[rows], *gather(sym, first, rows)))
                rows = np.flatnonzero(live)
                pair, _ = gather(pair, first, rows)
                best = (low[rows] & 0xFFFFFFFF) - first[rows]
                sym, first = gather(sym, first, rows)
                word, best = word[rows], best + first[:-1]
            else:
                best = low & 0xFFFFFFFF
            sym[best] = self.joined[pair[best]]
            keep = np.ones(len(sym), bool)
            keep[best + 1] = False
            pair[best] = pair[best + 1]
            sym, pair = sym[keep], pair[keep]
            best -= np.arange(len(best))
            first = first - np.arange(len(first))
            more = best[best + 1 < first[1:]]
            pair[more] = self._pairs(sym[more], sym[more + 1])
            more = best[best > first[:-1]] - 1
            pair[more] = self._pairs(sym[more], sym[more + 1])
        if not done:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        word = np.concatenate([x[0] for x in done])
        sizes = np.concatenate([np.diff(x[2]) for x in done])
        sym, at = gather(np.concatenate([x[1] for x in done]), offsets(sizes), np.argsort(word))
        sizes = np.diff(at)
        if (sym < 0).any():
            parts = [[s] if s >= 0 else self.byte_id[list(chr(-1 - s).encode())].tolist() if self.byte_fallback else [self.unknown] for s in sym.tolist()]
            sizes = np.diff(offsets(np.fromiter(map(len, parts), np.int64, len(parts)))[at])
            sym = np.array([i for p in parts for i in p], np.int64)
        return sym.astype(np.uint32), sizes

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The text that is merged, and the source byte of each of its characters and of the end."""
        norm, source = self.char_map.normalise(text)
        if self.trim:
            spans = [m.span() for m in re.finditer("[^ ]+", norm)]
            keep = np.concatenate([np.arange(a - (k > 0), b) for k, (a, b) in enumerate(spans)]) if spans else np.zeros(0, np.int64)
            norm, source = " ".join(norm[a:b] for a, b in spans), np.append(source[keep], source[-1])
        if norm and self.dummy_prefix:
            norm, source = " " + norm, np.concatenate([[0], source])
        return norm.replace(" ", SPACE) if self.escape else norm, source

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids with begin and end ids, the offsets of the texts, and for each id the first
        and the last (exclusive) byte of the source text."""
        normal = [self.normalise(t) for t in texts]
        words = [self.word.findall(n) for n, _ in normal]
        ids, at = self.words.lookup([w for x in words for w in x])
        word_at = offsets(np.array([len(x) for x in words], np.int64))
        out, first, last = [], [], []
        for i, (norm, source) in enumerate(normal):
            own = ids[at[word_at[i]] : at[word_at[i + 1]]]
            a, b = self._spans(own, norm, source)
            end = source[-1] if len(source) else 0
            out.append(np.concatenate([[self.begin], own, [self.end]]))
            first.append(np.concatenate([[0], a, [end]]))
            last.append(np.concatenate([[0], b, [end]]))
        none = np.zeros(0, np.int64)
        join = lambda x: np.concatenate([none, *x]).astype(np.int64)
        return join(out).astype("<u4"), offsets(np.array([len(x) for x in out], np.int64)), join(first), join(last)

    def _spans(self, ids: np.ndarray, norm: str, source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        byte = self.is_byte[ids] | (ids == self.unknown)
        if not byte.any():
            edge = source[offsets(self.n_chars[ids])]
            return edge[:-1], edge[1:]
        # a run of byte pieces spells characters: only the first byte of one moves on
        value = np.zeros(len(ids), np.int64)
        value[byte] = self.surface[self.surface_at[ids[byte]]]
        follows = byte & ((value & 0xC0) == 0x80) & self.is_byte[ids]
        chars = np.where(byte, ~follows, self.n_chars[ids])
        step = offsets(chars)
        begin = source[np.where(follows, step[:-1] - 1, step[:-1])]
        inside = np.arange(len(ids)) - np.maximum.accumulate(np.where(follows, 0, np.arange(len(ids))))
        begin = np.where(follows, begin + inside, begin)
        ends = np.append(begin[1:], source[-1])
        return begin, ends

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that spell no character become U+FFFD each."""
        data = gather(self.surface, self.surface_at, ids.astype(np.int64))[0].tobytes()
        solid = ids[~np.isin(ids, [self.begin, self.end])]
        if (self.dummy_prefix or self.trim) and len(solid) and self.pieces[solid[0]].startswith(SPACE):
            data = data[1:]
        return data.decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    with open(path, "rb") as f:
        return Codec(f.read())


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ``ids``, and ``first`` and ``last``: the source bytes of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = codec(model_path)
        for batch in batches:
            for part in W.blocks(batch, "text"):
                ids, at, first, last = sp.encode([t or "" for t in part.column("text").to_pylist()])
                lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x.astype(np.int64))) for x in (ids, first, last)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *lists], ["doc_id", "ids", "first", "last"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<long>, first array<long>, last array<long>")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and ``text`` of rows with ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = codec(model_path)
        for batch in batches:
            texts = [sp.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def code_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids and of the text decoded from them, and a CRC-32
    of the source spans: encoding and decoding in one pass that ships no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = codec(model_path)
        for batch in batches:
            for part in W.blocks(batch, "text"):
                ids, at, first, last = sp.encode([t or "" for t in part.column("text").to_pylist()])
                rows = [slice(a, b) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(at)),
                        pa.array([hashlib.sha256(ids[r].tobytes()).hexdigest() for r in rows], pa.string()),
                        pa.array([hashlib.sha256(sp.decode(ids[r]).encode()).hexdigest() for r in rows], pa.string()),
                        pa.array([zlib.crc32(np.stack([first[r], last[r]], 1).astype("<u4").tobytes()) for r in rows], pa.int64()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long")


def model_file() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_digests(table(spark, sf_dir, "documents"), model_file())
