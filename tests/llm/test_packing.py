"""Packing against a plain best fit over a list of rooms, and against the tokenizer itself."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from framewright.llm import packing as P
from framewright.llm.token_binary import tokenizer_file

TEXTS = [None, "", " ", "a few words", "héllo 🦄 wörld", "word " * 5000, "z" * 9000, "<|endoftext|> twice <|endoftext|>", "same text", "same text", *(f"text {i} " * (i * 7 % 400) for i in range(120))]
SCHEMA = "doc_id long, text string, sequence_id string, pieces string, ids long"


def _tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


def _best_fit(sizes, capacity, rooms):
    left, window = list(rooms), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [r for r in left if r >= sizes[i]]
        w = len(left) if not fits else next(k for k in reversed(range(len(left))) if left[k] == min(fits))
        left += [capacity] * (w == len(left))
        left[w] -= sizes[i]
        window[i] = w
    return window, left


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60), st.lists(st.integers(0, 20), max_size=5))
def test_every_piece_goes_into_the_tightest_window(sizes, rooms):
    window, left = P.best_fit_decreasing(np.array(sizes, np.int64), 20, np.array(rooms, np.int64))
    assert sorted(left.tolist()) == sorted(_best_fit(sizes, 20, rooms)[1])  # windows of equal room are alike
    filled = [20 - r for r in left]
    for k, r in enumerate(rooms):
        filled[k] -= 20 - r
    assert filled == [sum(s for s, w in zip(sizes, window, strict=True) if w == k) for k in range(len(left))]


def test_pools_keep_windows_open(monkeypatch):
    monkeypatch.setattr(P, "POOL_TOKENS", 3000)
    monkeypatch.setattr(P, "MOST_OPEN", 3)
    rng, packer, docs, out = np.random.default_rng(5), P.Packer(7 << 33, 64, 0), {}, []
    for block in range(40):
        sizes = rng.integers(1, 200, 20)
        ids = rng.integers(1, 50_000, sizes.sum()).astype("<u4")
        for k, part in enumerate(np.split(ids, np.cumsum(sizes)[:-1])):
            docs[block * 20 + k] = part.tolist()
        out += packer.add(pa.array(block * 20 + np.arange(20)), ids, sizes)
    out += packer.pack()
    got, numbers = {}, []
    for batch in out:
        for row in batch.to_pylist():
            numbers.append(row["sequence_id"])
            ids = np.frombuffer(row["ids"], "<u4").tolist()
            assert sum(p["length"] for p in row["pieces"]) == row["n_tokens"] <= 64
            assert len(ids) == (row["n_tokens"] if row["n_tokens"].bit_count() == 1 else 64)
            at = 0
            for p in row["pieces"]:
                assert p["offset"] == at and p["doc_tokens"] == len(docs[p["doc_id"]])
                got.setdefault(p["doc_id"], []).append((p["start"], ids[at : at + p["length"]]))
                at += p["length"]
            assert not any(ids[at:])
    assert sorted(numbers) == [(7 << 33) + k for k in range(len(numbers))]
    for doc, parts in got.items():
        parts.sort()
        assert [s for s, _ in parts] == np.cumsum([0, *(len(x) for _, x in parts)])[:-1].tolist()
    assert {d: sum((x for _, x in p), []) for d, p in got.items()} == docs
    assert sum(map(len, docs.values())) > 0.98 * 64 * len(numbers)


def test_long_texts_are_encoded_in_stretches(monkeypatch):
    monkeypatch.setattr(P, "LONG_TEXT", 50)
    tokenizer = _tokenizer()
    for text in ("some words  and   spaces \n of a text. " * 20, "z" * 300, "héllo 🦄 <|endoftext|> " * 9, ""):
        assert P.encode_long(text, tokenizer_file(), 0).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_rows(spark):
    rows = [(None if k == 1 else k // 2, t, "mine", None, 1) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    packed = P.pack_documents(docs, tokenizer_file(), 256, pad_id=9)
    got = P.piece_rows(packed).collect()
    tokenizer = _tokenizer()
    want = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t, *_ in rows]
    left = [(i, len(ids), ids[k : k + 256]) for i, ids in want for k in range(0, len(ids), 256)]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted(map(repr, ((r.doc_id, r.doc_tokens, r.length, r.ids_crc32) for r in got))) == sorted(map(repr, ((i, n, len(x), crc(x)) for i, n, x in left)))
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all([o for o, _ in sorted(x)] == np.cumsum([0, *(n for _, n in sorted(x))])[:-1].tolist() for x in held.values())
    assert all(sum(n for _, n in x) <= 256 for x in held.values())
    assert {r.sequence_id: r.n_tokens for r in packed.collect()} == {s: sum(n for _, n in x) for s, x in held.items()}
    assert P.piece_rows(P.pack_documents(docs.limit(0), tokenizer_file())).count() == 0
