"""Fill-in-the-middle: texts cut at two units, in the order prefix, suffix, middle or suffix, prefix, middle.

A text is stored as its maximal runs of one class of characters (:class:`Runs`): where each run ends, and
how many units end up to there.  A cut after unit u is found by binary search for the first run
with at least u unit ends, and its offset by arithmetic: in a run whose every character ends a unit the
surplus counts back from the run's end, in any other run the unit ends where the run does.  Texts are
never split into units.  Units are lines (with their line break), words (with the white space before them) or
characters.

Cuts and forms come from the SHA-256 of ``seed:doc_id``, so they don't depend on how rows are dealt.  A
text is left plain if it is empty, holds a sentinel, falls outside ``rate``, or couldn't be rebuilt from the
output (sentinels that overlap themselves).  Every row is worked on alone: no shuffle, nothing written.

Null texts count as empty and give the plain form; a null doc_id hashes as an empty number; repeated rows
give equal rows; texts are cut whole, whatever their length; an empty table gives no rows.  Only doc_id and
text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import words as W
from framewright.storage import table

#: For each kind of unit a pattern of its runs and whether every character of a run that the group matches ends a
#: unit, or only the last one.  Runs of the other class end one at the end of a text only.
UNITS = {"line": (re.compile(r"(\n+)|[^\n]+"), True), "word": (re.compile(r"(\S+)|\s+"), False), "char": (re.compile(r"(.+)", re.S), True)}


@dataclass(frozen=True)
class Runs:
    """Maximal runs of a text: the offset where each ends, unit ends up to there, and whether the first one
    (and every second one from it) ends a unit with each of its characters."""

    ends: np.ndarray
    units: np.ndarray
    first_each: bool
    other_each: bool

    @property
    def n(self) -> int:
        return int(self.units[-1]) if len(self.units) else 0

    def cut(self, u: int) -> int:
        """The offset after ``u`` units, from 0 to n."""
        if u == 0:
            return 0
        r = int(np.searchsorted(self.units, u))
        each = self.other_each if r % 2 else self.first_each
        return int(self.ends[r] - (self.units[r] - u if each else 0))


def runs_of(text: str, unit: str = "line") -> Runs:
    pattern, each = UNITS[unit]
    ends = np.fromiter((m.end() for m in pattern.finditer(text)), np.int64)
    first = bool(text) and pattern.match(text)[1] is not None  # classes take turns
    marked = np.arange(len(ends)) % 2 == (0 if first else 1)
    more = np.where(marked, np.diff(ends, prepend=0) if each else 1, 0)
    if len(ends) and not marked[-1]:
        more[-1] = 1  # what follows the last end is a unit too
    return Runs(ends, np.cumsum(more), each and first, each and not first)


@dataclass(frozen=True)
class FimParams:
    """``rate`` percent of texts are transformed, of these ``spm`` percent with the suffix first."""

    seed: int = 7
    rate: int = 100
    spm: int = 50
    unit: str = "line"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def sentinels(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def draws(seed: int, doc_id: object) -> list[int]:
    """Four numbers below 2**32 of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def parted(output: str, form: str, p: FimParams) -> tuple[str, str, str] | None:
    """Prefix, middle and suffix of an output that isn't plain, or None if it isn't one."""
    marks = (p.prefix, p.suffix, p.middle) if form == "psm" else (p.suffix, p.prefix, p.middle)
    if not output.startswith(marks[0]):
        return None
    first, a, rest = output[len(marks[0]) :].partition(marks[1])
    second, b, third = rest.partition(marks[2])
    return None if not (a and b) else (first, third, second) if form == "psm" else (second, third, first)


def transform(text: str, doc_id: object, p: FimParams) -> tuple[int, str, int | None, int | None, str]:
    """Number of units, form, code points of prefix and middle (None if plain), and output."""
    runs, (h1, h2, h3, h4) = runs_of(text, p.unit), draws(p.seed, doc_id)
    if not text or any(s in text for s in p.sentinels()) or h3 % 100 >= p.rate:
        return runs.n, "plain", None, None, text
    a, b = (runs.cut(u) for u in sorted((h1 % (runs.n + 1), h2 % (runs.n + 1))))
    form = "spm" if h4 % 100 < p.spm else "psm"
    first, second = ((p.suffix, text[b:]), (p.prefix, text[:a])) if form == "spm" else ((p.prefix, text[:a]), (p.suffix, text[b:]))
    output = "".join((*first, *second, p.middle, text[a:b]))
    if parted(output, form, p) != (text[:a], text[a:b], text[b:]):
        return runs.n, "plain", None, None, text
    return runs.n, form, a, b - a, output


def fill_in_middle(docs: DataFrame, p: FimParams = FimParams()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and ``output`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.blocks(batch, "text"):
                ids, texts = (part.column(c).to_pylist() for c in ("doc_id", "text"))
                cols = zip(*(transform(t or "", i, p) for i, t in zip(ids, texts, strict=True)), strict=True)
                types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(p: FimParams = FimParams()) -> Column:
    """The text that ``form`` and ``output`` hold, from nothing else."""
    quoted = {s: re.sub(r"([^\w])", r"\\\1", s, flags=re.A) for s in p.sentinels()}

    def pieces(first: str, second: str) -> Column:
        rest = F.substr("output", F.lit(len(first) + 1), F.char_length("output"))
        two = F.split(rest, quoted[second], 2)
        return F.array(two[0], *(F.split(two[1], quoted[p.middle], 2)[k] for k in (0, 1)))

    psm, spm = pieces(p.prefix, p.suffix), pieces(p.suffix, p.prefix)
    return F.when(F.col("form") == "psm", F.concat(psm[0], psm[2], psm[1])).when(F.col("form") == "spm", F.concat(spm[1], spm[2], spm[0])).otherwise(F.col("output"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS pieces,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
u AS (SELECT *, CAST(len(pieces) - CASE WHEN pieces[-1] = '' THEN 1 ELSE 0 END AS BIGINT) AS n FROM d),
c AS (
  SELECT *, CAST(CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS BIGINT) AS u1, CAST(CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS BIGINT) AS u2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4
  FROM u),
e AS (
  SELECT *, CASE WHEN least(u1, u2) = n THEN text WHEN least(u1, u2) = 0 THEN '' ELSE array_to_string(pieces[1:least(u1, u2)], chr(10)) || chr(10) END AS before,
         CASE WHEN greatest(u1, u2) = n THEN text WHEN greatest(u1, u2) = 0 THEN '' ELSE array_to_string(pieces[1:greatest(u1, u2)], chr(10)) || chr(10) END AS reach
  FROM c),
f AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 100 THEN 'plain' WHEN h4 < 50 THEN 'spm' ELSE 'psm' END AS form,
         substr(reach, length(before) + 1) AS middle, substr(text, length(reach) + 1) AS suffix
  FROM e)
SELECT doc_id, n, form,
       CAST(CASE WHEN form <> 'plain' THEN length(before) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || before || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || before || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM f
"""
