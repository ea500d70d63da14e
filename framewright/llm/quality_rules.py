"""Quality rules kept as a bitmask ledger.

:func:`rule_ledger` evaluates every rule once per document and stores what was
measured together with one failure bit per rule.  Policies are versioned masks
over those bits: :func:`apply_policy` keeps a document if none of its bits lies
in the mask, and :func:`ablations` tells, from counts of the bit patterns alone,
what each rule removes and what would come back without it.  No text is read
again to try another policy.

Null or empty texts have no words: every count is 0 and ``too_few_words`` fails.
Repeated rows and equal ids are judged row by row; other columns are not read.
Words are compared by 128-bit digests; windows of one document by a hash, and where that is
equal by the digests of all their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import words as W
from framewright.storage import table

REPEAT_WIDTH = 5
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_marks", "n_alpha_words", "n_stutter")

#: Rule name -> condition, over the measures, under which a document fails it.  The place in the list is the bit.
RULES = {
    "too_few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 25 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "shouting": "100 * n_upper > 30 * n_letters",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    "few_alphabetic_words": "100 * n_alpha_words < 75 * n_words",
    "exclamations": "100 * n_marks > 20 * n_words",
    "stutter": "100 * n_stutter > 20 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """A named version of which rules count."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


BASE_POLICY = Policy("base-1", ("too_few_words", "repeated_windows"))
FULL_POLICY = Policy("full-1", tuple(RULES))


def _class(*members: bytes | range) -> np.ndarray:
    out = np.zeros(256, bool)
    for m in members:
        out[list(m)] = True
    return out


_SYMBOL = _class(SYMBOLS)
_UPPER = _class(range(65, 91))
_LETTER = _class(range(65, 91), range(97, 123))
_ALPHA = _class(range(65, 91), range(97, 123), range(128, 256))
_CONTINUES = _class(range(128, 192))


def _lines(text: bytes) -> tuple[int, int]:
    """Lines that hold a word, and how many of them equal an earlier one."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def measure(texts: list[bytes], words: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> dict[str, np.ndarray]:
    """The measures of each text; ``words``: what :func:`words.word_digests` found in them, if known."""
    buf, at = W.text_bytes(texts)
    first, last = at[:-1], at[1:] - 1
    starts, ends, words = words or W.word_digests(buf)
    word_at = np.searchsorted(starts, at)
    n_words = np.diff(word_at)

    def count(mask: np.ndarray) -> np.ndarray:
        sums = W.running(mask)
        return sums[last] - sums[first]

    owner = np.repeat(np.arange(len(texts), dtype=np.int64), n_words)
    n_repeat = np.zeros(len(texts), np.int64)
    windows, _ = W.window_hashes(words, REPEAT_WIDTH)
    if len(windows):
        inside = owner[: len(windows)] == owner[REPEAT_WIDTH - 1 :]
        place = np.flatnonzero(inside)
        order = np.lexsort((windows[place], owner[place]))
        place, keys = place[order], windows[place][order]
        pair = np.flatnonzero((keys[1:] == keys[:-1]) & (owner[place[1:]] == owner[place[:-1]]))
        for k in range(REPEAT_WIDTH):
            pair = pair[(words[place[pair] + k] == words[place[pair + 1] + k]).all(axis=1)]
        hit = np.zeros(len(words), bool)
        hit[place[pair]] = hit[place[pair + 1]] = True
        n_repeat = np.bincount(owner[W.covered(hit, REPEAT_WIDTH, len(words))], minlength=len(texts))
    alpha = W.running(_ALPHA[buf])
    echo = np.zeros(len(words), bool)
    echo[1:] = (words[1:] == words[:-1]).all(axis=1) & (owner[1:] == owner[:-1])
    lines = np.array([_lines(t) for t in texts], np.int64).reshape(-1, 2)
    return {
        "n_words": n_words,
        "word_chars": count(~W.IS_SPACE[buf] & ~_CONTINUES[buf]),
        "n_symbols": count(_SYMBOL[buf]),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": n_repeat,
        "n_lines": lines[:, 0],
        "n_letters": count(_LETTER[buf]),
        "n_upper": count(_UPPER[buf]),
        "n_marks": count(buf == ord("!")),
        "n_alpha_words": np.bincount(owner[alpha[ends] > alpha[starts]], minlength=len(texts)),
        "n_stutter": np.bincount(owner[echo], minlength=len(texts)),
    }


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.blocks(batch, "text"):
            got = measure([(t or "").encode() for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(got[m].astype(np.int64)) for m in MEASURES)], ["doc_id", *MEASURES])


def rule_ledger(docs: DataFrame) -> DataFrame:
    """doc_id, every measure, and ``fail_bits`` with the bit of every failed rule."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    got = docs.select("doc_id", "text").mapInArrow(_measured, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, rule in enumerate(RULES.values())]
    total: Column = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return got.withColumn("fail_bits", total)


def apply_policy(ledger: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept`` and the policy's version."""
    return ledger.withColumns({"kept": F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0, "policy": F.lit(policy.version)})


def ablations(ledger: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: documents that fail it, documents that fail nothing
    else in the policy (they come back without the rule), and documents kept without it.
    Works on the counts of the distinct bit patterns, of which there are at most 2**rules."""
    patterns = ledger.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count("*").alias("n"))
    rule = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << list(RULES).index(r)).cast("long").alias("bit")) for r in policy.rules)))
    each = patterns.select("bits", "n", rule.alias("r")).select("bits", "n", "r.rule", "r.bit")
    rest = F.col("bits").bitwiseAND(F.bitwise_not("bit"))
    n_if = lambda c: F.sum(F.when(c, F.col("n")).otherwise(F.lit(0))).cast("long")
    return each.groupBy("rule").agg(
        n_if(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        n_if(F.col("bits") == F.col("bit")).alias("n_failed_alone"),
        n_if(rest == 0).alias("n_kept_without"),
    )


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = rule_ledger(table(spark, sf_dir, "documents"))
    base = F.col("fail_bits").bitwiseAND(F.lit(BASE_POLICY.mask)) != 0
    return apply_policy(ledger, FULL_POLICY).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "fail_bits", "policy")


_WORD = r"[^\x20\x09-\x0D]+"
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM d),
g AS (SELECT r, i, hash(w[i], w[i+1], w[i+2], w[i+3], w[i+4]) AS h
      FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w)),
rep AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, h) > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0,1,2,3,4]) AS k) GROUP BY r),
m AS (SELECT w.r, doc_id, len(w)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
             length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) AS n_letters,
             length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
             length(t) - length(replace(t, '!', '')) AS n_marks,
             len(list_filter(w, lambda x: regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]'))) AS n_alpha_words,
             len(list_filter(w, lambda x, i: i > 1 AND w[i-1] = x)) AS n_stutter
      FROM w LEFT JOIN cov ON w.r = cov.r),
b AS (SELECT *, ({" + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES.values()))})::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & {BASE_POLICY.mask} <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits, '{FULL_POLICY.version}' AS policy
FROM b
"""
