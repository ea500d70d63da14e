"""Encoding of blocks of texts by their different words, against the tokenizer itself."""

from __future__ import annotations

import json
import sys

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from framewright.llm import token_binary as T
from framewright.llm.ragged import WordMemory

PATH = T.tokenizer_file()
SPACES = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]
PARTS = ["a", "Word", "it's", "we'll.", "3.14", "1,000", "e.g.", "x,y", ".", ",", "...", "'", "<", "|", "<|", "<|endoftext|>", "é", "à", "ß.", "ɏ", "ɂ", "Ж,", "漢字", "🦄", "’", "…", "»", "\x7f", "\x1c", "\x00", "é", *SPACES, "  ", "\n\n", "\r\n", " \n ", "\t\t"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def _same(tokenizer, texts, column):
    ids, sizes = T.encode(column, PATH, 2)
    want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert sizes.tolist() == list(map(len, want))
    assert ids.tolist() == sum(want, [])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from([*PARTS, " ", " ", " "]), max_size=30).map("".join)), max_size=6))
def test_ids_are_those_of_the_tokenizer(tokenizer, texts):
    _same(tokenizer, texts, pa.array(["x", *texts], pa.string()).slice(1))


def test_white_space_of_any_kind(tokenizer):
    near = [chr(c) for c in (*range(0x80, 0x100), *range(0x1660, 0x16A0), *range(0x2000, 0x2080), *range(0x3000, 0x3040))]
    texts = [f"a{c} b {c}c{c}\nd.{c}\t {c}, e{c}" for c in {*SPACES, *near}]
    _same(tokenizer, texts, pa.array(texts, pa.large_string()))


def test_texts_in_stretches(tokenizer, monkeypatch):
    monkeypatch.setattr(T, "ENCODED_PIECES", 3)
    texts = ["one, two.\nthree  four", "", None, " ", "five six seven eight. nine", "ten"]
    _same(tokenizer, texts, pa.array(texts))
    _same(tokenizer, [], pa.array([], pa.string()))


def test_a_forgetful_memory(tokenizer, monkeypatch):
    monkeypatch.setattr("framewright.llm.ragged.MOST_WORDS", 2)
    monkeypatch.setattr(T, "ENCODED_PIECES", 4)
    texts = [f"word {i % 3} word{i % 5}, and more {i}." for i in range(50)]
    _same(tokenizer, texts, pa.array(texts))


def test_each_word_of_a_block_is_looked_up_once(monkeypatch):
    """Looking up every occurrence took most of the time of a task (406 CPU seconds a GB were measured)."""
    asked = []
    for name in ("lookup", "lookup_distinct"):
        if plain := getattr(WordMemory, name, None):
            monkeypatch.setattr(WordMemory, name, lambda self, words, *more, plain=plain: asked.append(len(words)) or plain(self, words, *more))
    texts = ["the same few words, again. The same\nwords again."] * 1000
    _, sizes = T.encode(pa.array(texts), PATH, 2)
    assert sizes.sum() > 10_000 and sum(asked) <= 12


def test_a_tokenizer_of_another_pattern_is_cut_at_spaces_only(tmp_path):
    data = np.frombuffer("one two,\tthree.\nfour".encode(), np.uint8)
    assert T.cuts(data, pattern=False).tolist() == [3]
    assert T.cuts(data).tolist() == [3, 7, 8, 14, 15]
    with open(PATH, encoding="utf-8") as f:
        file = json.load(f)
    digits = {"type": "Split", "pattern": {"Regex": r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"}, "behavior": "Isolated", "invert": False}
    file["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [digits, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(file), encoding="utf-8")
    from tokenizers import Tokenizer

    text = "one two.\nThree, 1234567 (!)\n\n four's\tfive"
    ids, _ = T.encode(pa.array([text]), str(path), 2)
    assert ids.tolist() == [*Tokenizer.from_file(str(path)).encode(text, add_special_tokens=False).ids, 2]
