"""Words, word digests and window hashes of a block of texts, as numpy arrays.

A word is a run of characters other than space and ``\\t\\n\\v\\f\\r``; in UTF-8
those six are single bytes, so words are found on the bytes of a whole block.  Every
different word of a block gets a 128-bit digest (XXH3).  Windows are hashed by
Rabin-Karp: polynomials of the digests' parts modulo the prime 2**31 - 1, taken as
differences of running sums, three of them with bases of their own (93 bits).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PRIME = (1 << 31) - 1
#: One base for each of the three polynomials, any numbers below the prime.
BASES = (1_103_515_245, 1_664_525_013, 69_069_069)
WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
BLOCK_BYTES = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_P, _SHIFT = np.uint64(PRIME), np.uint64(31)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def running(x: np.ndarray) -> np.ndarray:
    """Sums of all before each place, and of all."""
    out = np.zeros(len(x) + 1, np.uint64 if x.dtype == np.uint64 else np.int64)
    np.cumsum(x, dtype=out.dtype, out=out[1:])
    return out


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes."""
    space = np.ones(len(buf) + 2, bool)
    space[1:-1] = IS_SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[0::2], edge[1::2]


def _digest_block(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends = word_spans(buf)
    flat, at = buf[~IS_SPACE[buf]], running(ends - starts)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(flat)]).dictionary_encode()
    each = b"".join(map(xxhash.xxh3_128_digest, words.dictionary.to_pylist()))
    return starts, ends, np.frombuffer(each, "<u8").reshape(-1, 2)[words.indices.to_numpy()]


def word_digests(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 128-bit digest (two columns) of each word, worked out in blocks that end at a
    space, so that the memory beside the result does not grow with the text."""
    parts, at = [], 0
    while at < len(buf):
        stop = min(len(buf), at + BLOCK_BYTES)
        while stop < len(buf) and not IS_SPACE[buf[stop - 1]]:
            stop += 1
        s, e, d = _digest_block(buf[at:stop])
        parts.append((s + at, e + at, d))
        at = stop
    if not parts:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros((0, 2), np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def residue(x: np.ndarray) -> np.ndarray:
    """Values below 2**62 modulo the prime."""
    x = (x & _P) + (x >> _SHIFT)
    x = (x & _P) + (x >> _SHIFT)
    return np.where(x >= _P, x - _P, x)


def _prime_powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo the prime."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = residue(out[:more] * np.uint64(pow(base, done, PRIME)))
        done += more
    return out


def window_hashes(digests: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of 62 and another of 31 bits of every ``width`` consecutive words; empty if there are fewer."""
    n = len(digests) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    each = []
    for base, part in zip(BASES, (digests[:, 0], digests[:, 0] >> np.uint64(32), digests[:, 1]), strict=True):
        sums = running(residue((part & _P) * _prime_powers(base, len(digests))))
        each.append(residue(residue(sums[width:] - sums[:-width]) * _prime_powers(pow(base, -1, PRIME), n)))
    return mix(each[0] | each[1] << _SHIFT), each[2]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column of texts, one newline after each, and n+1 offsets."""
    data = [(t or "").encode() for t in texts.to_pylist()] if not isinstance(texts, list) else texts
    buf = np.frombuffer(b"\n".join([*data, b""]), np.uint8)
    return buf, running(np.array([len(x) + 1 for x in data], np.int64))


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of text; a longer text makes one slice."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += size
    if first < batch.num_rows:
        yield batch.slice(first)


def covered(hit: np.ndarray, width: int, n_words: int) -> np.ndarray:
    """Which words lie in a window that ``hit`` marks by its first word."""
    step = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(hit)
    step[at] += 1
    step[at + width] -= 1
    return np.cumsum(step[:-1]) > 0
