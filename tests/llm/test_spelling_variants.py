"""Spelling variants against plain loops over all pairs of words."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from framewright.llm import spelling_variants as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SCHEMA = "doc_id long, text string, word string, n string, key long"


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _count(rows, noise=199):
    out = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                out[run] += 1
    return out


def _groups(counts, least=5, ratio=5):
    n = {w: c for w, c in counts.items() if c >= least}
    near = {w: sorted((x for x in n if _near(w, x)), key=lambda x: (-n[x], x)) for w in n}
    form = {w: xs[0] if xs and n[xs[0]] >= ratio * n[w] else None for w, xs in near.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w]) or 0) for w in n)


def _plain(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


TEXTS = [
    None, "", "12345 ,,, ", "Banana banana bananas BANANA bananna " * 9, "ÉCOLE École école écoles ×××××÷÷ " * 7, "bananāna x" * 5, "aaaaaaa " * 5 + "aaaaaaaa " * 40 + "aaaaaaaaa " * 5, ("z" * 3000 + " ") * 6 + ("z" * 3001 + " ") * 40 + ("z" * 2000 + "y" + "z" * 999 + " ") * 5,
    "separate " * 700 + "seperate " * 60 + "seperete " * 6 + "separated " * 5, "same words repeated again " * 5, "same words repeated again " * 5, "no_break_here naïveté naiveté " * 6, "tail-word ending",
]


def test_rows(spark):
    rows = [(None if k == 4 else k // 2, t, "mine", None, 1) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for noise in (199, 3):
        want = _count([(r[0], r[1]) for r in rows], noise)
        counts = S.count_words(docs, noise=noise)
        assert {r.word: r.n for r in counts.collect()} == want
    assert _plain(S.group_variants(counts)) == _groups(want)
    assert S.group_variants(S.count_words(docs.limit(0))).count() == 0


def _typos(seed, n):
    rng, base, out = np.random.default_rng(seed), ["abacus", "banana", "cabbage", "decade", "aaaaab"], Counter()
    for _ in range(n):
        w = base[rng.integers(len(base))]
        for _ in range(rng.integers(0, 4)):
            i, kind, c = rng.integers(len(w) + 1), rng.integers(3), "abcdeé"[rng.integers(6)]
            w = w[:i] + (c if kind else "") + w[i + (kind < 2) :]
        if len(w) >= 6:
            out[w] += int(rng.integers(1, 40))
    return out


@pytest.mark.parametrize("collide", [False, True])
def test_dense_words(spark, monkeypatch, collide):
    """Words with many near ones; also as if all keys were equal: strings decide."""
    counts = _typos(3, 1500)
    if collide:
        monkeypatch.setattr(S, "_shared", lambda keyed: keyed.selectExpr("0L AS key", "pos", "last", "id"))
    assert len(counts) > 300
    assert _plain(S.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), ratio=2)) == _groups(counts, ratio=2)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=1, max_size=8), min_size=1, max_size=12, unique=True))
def test_keys_are_those_of_what_is_left(words):
    word, key, pos, last = S.deletion_keys(words)
    left = [words[w] if p < 0 else words[w][:p] + words[w][p + 1 :] for w, p in zip(word.tolist(), pos.tolist(), strict=True)]
    by = {}
    for x, k in zip(left, key.tolist(), strict=True):
        assert by.setdefault(x, k) == k
    assert len(set(by.values())) == len(by)
    for k, w in enumerate(words):
        places = pos[(word == k) & last].tolist()
        assert sorted(places) == sorted(p for p in range(len(w)) if p == len(w) - 1 or w[p + 1] != w[p])
    order = np.lexsort((pos, key))
    found = S._sharing(key[order], pos[order], last[order])
    rows = [(left[i], int(pos[i]), bool(last[i]), int(word[i])) for i in order.tolist()]
    for at, (x, p, is_last, _) in enumerate(rows):
        same = [r for r in rows if r[0] == x]
        shares = sum(r[1] == p for r in same) > 1 if p >= 0 else any(r[2] for r in same)
        assert found[at] == (shares or is_last and any(r[1] < 0 for r in same))


def test_checksums_of_two_parts():
    prefixes, words = [b"1:", b"23:", b":"], [b"", b"a", b"word" * 15, "é".encode() * 40, b"x" * 500]
    owner, which = np.repeat(np.arange(3), 5), np.tile(np.arange(5), 3)
    assert S.checksums(owner, prefixes, words, which).tolist() == [zlib.crc32(prefixes[o] + words[w]) for o, w in zip(owner, which, strict=True)]


def test_long_texts_are_read_in_stretches(monkeypatch):
    monkeypatch.setattr(S, "STRETCH", 20)
    text = "some words and averyveryverylongword, then more of them "
    parts = list(S.stretches([1, 2], [text.encode() * 3, b""]))
    assert b"".join(t for _, ts in parts for t in ts).decode() == text * 3 and len(parts) > 3
    found = [w for _, ts in parts for w in S.word_runs(ts, 4)[1].to_pylist()]
    assert {w.decode() for w, _ in groupby(found)} == {w for w in RUN.findall(text) if len(w) >= 4}
