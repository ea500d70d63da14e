"""Fill-in-the-middle against texts that are really split into units."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from framewright.llm import fill_in_middle as fim

PLAIN = {"line": r"[^\n]*\n|[^\n]+", "word": r"\s*\S+|\s+\Z", "char": r"(?s:.)"}
TEXTS = [None, "", "\n", "\n\n\n", "one line", "a\nb\nc", "a\n\n\nb\n", "é🦄 ▁\n \t\r\n x\x0by", "with <P> in it\nand more", "a < P>\n<S\n>M>", "z" * 100_000 + "\n" + "y\n" * 50_000, "same\ntext\n", "same\ntext\n"]
SCHEMA = "doc_id long, text string, output string, form string, n string"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t\ré🦄<P>SM", max_size=40), st.sampled_from(sorted(PLAIN)))
def test_cuts_are_those_of_split_texts(text, unit):
    units = re.findall(PLAIN[unit], text)
    runs = fim.runs_of(text, unit)
    assert runs.n == len(units) and "".join(units) == text
    assert [runs.cut(u) for u in range(runs.n + 1)] == [len("".join(units[:u])) for u in range(len(units) + 1)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a\n<P>SM|", max_size=30), st.integers(0, 99), st.sampled_from(["<P>", "|", "||", "a"]))
def test_outputs_give_the_text_back(text, doc_id, prefix):
    p = fim.FimParams(prefix=prefix)
    _, form, _, _, output = fim.transform(text, doc_id, p)
    assert (output if form == "plain" else "".join(fim.parted(output, form, p))) == text


def _expected(doc_id, text):
    text = text or ""
    units = re.findall(PLAIN["line"], text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    before, middle, after = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, text, text
    output = f"<S>{after}<P>{before}<M>{middle}" if h[3] % 100 < 50 else f"<P>{before}<S>{after}<M>{middle}"
    return doc_id, n, "spm" if h[3] % 100 < 50 else "psm", len(before), len(middle), output, text


def test_rows(spark):
    rows = [(None if k == 4 else k // 2, t, "mine", "clash", None) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = fim.fill_in_middle(docs).select("*", fim.restored().alias("back")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(_expected(r[0], r[1])) for r in rows)
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


@pytest.mark.parametrize("unit", ["word", "char"])
def test_other_units_and_rates(spark, unit):
    p = fim.FimParams(seed=3, rate=60, spm=100, unit=unit, prefix="{pre}", suffix="[suf]", middle="$mid$")
    docs = spark.createDataFrame([(i, f"some words {i}\n and  more 🦄 of {i * i}  ") for i in range(200)], "doc_id long, text string")
    got = fim.fill_in_middle(docs, p).select("*", fim.restored(p).alias("back")).collect()
    assert {r.doc_id: r.back for r in got} == {r.doc_id: r.text for r in docs.collect()}
    share = sum(r.form == "spm" for r in got) / len(got)
    assert {r.form for r in got} == {"spm", "plain"} and 0.45 < share < 0.75
