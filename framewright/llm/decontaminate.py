"""Benchmark questions in documents, also with other numbers, names and units.

1. A template: names (runs of capitalised words inside a sentence), numbers (digits, or runs of number words) and units
   (words behind a number that are no ``FUNCTION_WORDS``) become one typed placeholder each, whatever their
   words; everything else is lower-cased words without punctuation.  An item with names is also taken with
   its names as words, for documents without capitals or all in them.
2. Windows: the hash of ``WIDTH`` tokens (of all tokens of a shorter item) at every place of an
   item and of a document, so each common stretch of that length has a window on both sides.  They
   are taken of templates, and where an item's window has under ``LEAST_LITERALS`` plain words, of
   the words and values themselves, which match as they are only.
3. Windows of documents and items are hash-joined, in one pass over the documents.  Up to
   ``MOST_BROADCAST`` windows of items the join is a broadcast and the documents stay where they
   are; beyond that hashes and places alone are shuffled, and documents with a match are fetched again.
4. A match lays the item over the document; equal tokens (or equal words behind their marks) count.  The slots must be
   consistent: one value of the item always meets the same value of the document.  If they are not, slots
   are judged within matching stretches of ``WIDTH`` tokens only; if those don't fit either, only what is
   equal word for word counts.  Of such overlays runs of ``LEAST_LITERALS`` tokens and more are counted.
5. A document leaks an item if its consistent matches cover ``LEAST_SHARE`` of the item's tokens, or
   ``LEAST_RUN`` of them in a row, whatever the item's length.  Long items are laid in parts of
   ``STEP`` tokens with those around them (more before than such a run, a window behind); the counts of an
   item's parts are added up.

Everything runs as built-in expressions.  A row holds the tokens of one document, or those under one
part of one item, never all matches of a document.

Null and empty texts match nothing.  An item of fewer than ``WIDTH`` tokens is found as a whole
only, one of a single word in every document with this word.  Texts are judged one by one; those that share a doc_id (null too) or an item_id give one row, the best match.  Other columns than the ids and texts are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.storage import materialize, table

WIDTH = 8
LEAST_LITERALS = 4
LEAST_SHARE = 0.5
LEAST_RUN = 50
STEP, LEAD, TAIL = 184, 64, WIDTH
#: Windows of items (and tokens of their parts) that may be broadcast: some 100 bytes each in memory.
MOST_BROADCAST = 500_000
NAME, NUMBER, UNIT, JOIN = "\ue001", "\ue002", "\ue003", "\ue004"
#: Words of numbers ("one" only within them), and words behind a number that are no unit.
NUMBER_WORDS = (
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
FUNCTION_WORDS = (
    "a an the and or but nor of to in on at by for from with without into onto over under than as that this these those then "
    "is are was were be been has have had do does did will would can could may might must not if when while who which what how "
    "he she it they we you i his her its their our your my him them us more less times"
).split()

_SLOT = f"[{NAME}{NUMBER}{UNIT}]"
#: The words of numbers by their first letters, so that most words are left at theirs.
_NUMBER_WORD = "|".join(f"{a}(?:{'|'.join(w[1:] for w in NUMBER_WORDS if w[0] == a)})" for a in dict.fromkeys(w[0] for w in NUMBER_WORDS))
_UNIT_STEP = (rf"({NUMBER}[^ ]+ )(?!(?:{'|'.join(FUNCTION_WORDS)})(?![^ ]))(\p{{L}}+(?![^ ]))", f"$1{UNIT}$2")


def marked(text: Column) -> Column:
    """The text as lower-case tokens parted by single spaces, slots with their mark in front."""
    named = (
        (f"[{NAME}{NUMBER}{UNIT}{JOIN}]", ""),
        (r"\p{Lu}(?<=[\p{L}\p{Nd},;]\s\p{Lu})\p{Ll}+(?!\p{L})", NAME + "$0"),
        (rf"\s{NAME}(?<={NAME}\p{{L}}{{1,40}}\s{NAME})", JOIN),
        (r"[.,](?!\p{Nd})", " "),
        (rf"[^\p{{L}}\p{{Nd}}.,{NAME}{JOIN}]+", " "),
    )
    # plain lower-case patterns that begin with a blank or a mark, so that most places are left at their first character
    valued = (
        (rf" {NAME}?({_NUMBER_WORD})(?![^ ])", f" {NUMBER}$1"),
        (rf" one(?![^ ])(?<={NUMBER}[a-z]{{3,9}} one)", f" {NUMBER}one"),
        (rf" {NUMBER}(?<={NUMBER}[a-z]{{3,9}} {NUMBER})", JOIN),
        (r"\p{Nd}[\p{Nd}.,]*", NUMBER + "$0"),
        _UNIT_STEP,
    )
    replaced = lambda t, steps: reduce(lambda t, step: F.regexp_replace(t, *step), steps, t)
    words = F.lower(replaced(F.coalesce(text, F.lit("")), named))
    return F.trim(replaced(F.concat(F.lit(" "), words), valued))


def templated(marked_text: Column) -> Column:
    """The tokens with bare placeholders for slots."""
    return F.split(F.regexp_replace(marked_text, rf"({_SLOT})[^ ]+", "$1"), " ")


def bared(marked_text: Column) -> Column:
    """The tokens without their marks."""
    return F.split(F.regexp_replace(marked_text, _SLOT, ""), " ")


def item_parts(benchmark: DataFrame) -> DataFrame:
    """pid, item (a row of the benchmark, twice if it has names), item_id, n_tokens of the item, ``lead`` (tokens before those that the
    part counts), ``own`` (how many it counts), ``item_v`` and ``item_t``: values and template, and ``window_t``, the template that
    windows are taken of.  The second form of an item has a token for each word of a name, and windows with these as words, for
    documents without capitals or all in them."""
    given = benchmark.select("item_id", marked(F.col("text")).alias("marked")).where("marked <> ''")
    apart = F.regexp_replace("marked", f"(?<={NAME}[^ ]{{1,400}}){JOIN}", f" {NAME}")
    plain = F.regexp_replace(F.regexp_replace(apart, NAME, ""), *_UNIT_STEP)
    form = lambda text, windows: F.struct(text.alias("marked"), windows.alias("windows"))
    given = given.select("item_id", F.explode(F.array_distinct(F.array(form(F.col("marked"), F.col("marked")), form(apart, plain)))).alias("f"))
    items = given.select(F.monotonically_increasing_id().alias("item"), "item_id", F.split("f.marked", " ").alias("v"), templated(F.col("f.marked")).alias("t"), templated(F.col("f.windows")).alias("w"))
    last = f"greatest(0, size(v) - {TAIL + 1}) DIV {STEP} * {STEP}"
    parts = items.select("item", "item_id", "v", "t", "w", F.explode(F.expr(f"sequence(0, CAST({last} AS INT), {STEP})")).alias("at"))
    parts = parts.withColumns({"lead": F.expr(f"least(at, {LEAD})"), "own": F.expr(f"CAST(IF(at = {last}, size(v) - at, {STEP}) AS INT)")})
    tokens = [F.expr(f"slice({c}, at - lead + 1, lead + own + {TAIL})").alias(name) for c, name in (("v", "item_v"), ("t", "item_t"), ("w", "window_t"))]
    return parts.select(F.monotonically_increasing_id().alias("pid"), "item", "item_id", F.size("v").cast("long").alias("n_tokens"), "lead", "own", *tokens)


def window_hash(kind: int, width: int, tokens: str, at: str) -> str:
    """SQL for the hash of ``width`` tokens from a place on: plain compiled code, no lambda a place."""
    return f"xxhash64({kind}, {width}, {', '.join(f'get({tokens}, {at} + {i})' for i in range(width))})"


def item_windows(parts: DataFrame) -> DataFrame:
    """pid, place ``q``, ``kind`` (0: of the template, 1: of the words themselves), ``width`` and hash ``h`` of
    each window of each part, and ``before``, the hash of the same kind one place before."""
    bare = F.transform("item_v", lambda t: F.regexp_replace(t, "^" + _SLOT, "")).alias("bare")
    both = parts.select("pid", F.col("window_t").alias("t"), bare).withColumn("width", F.least(F.size("t"), F.lit(WIDTH)))
    each = both.select("pid", "t", "bare", "width", F.explode(F.expr("sequence(0, size(t) - width)")).alias("q"))
    slot = f"x IN ('{NAME}', '{NUMBER}', '{UNIT}')"
    kind = lambda q: f"IF(size(filter(slice(t, {q} + 1, width), x -> NOT {slot})) >= {LEAST_LITERALS}, 0, 1)"
    each = each.withColumns({"kind": F.expr(kind("q")), "kind_before": F.expr(f"IF(q > 0, {kind('greatest(q - 1, 0)')}, NULL)")})
    hashed = lambda q: "CASE " + " ".join(f"WHEN kind = {k} AND width = {w} THEN {window_hash(k, w, c, q)}" for k, c in ((0, "t"), (1, "bare")) for w in range(1, WIDTH + 1)) + " END"
    return each.select("pid", "width", "q", "kind", F.expr(hashed("q")).alias("h"), F.expr(f"IF(kind_before = kind, {hashed('q - 1')}, NULL)").alias("before")).distinct()


def _tokens(docs: DataFrame) -> DataFrame:
    """doc_id, ``row`` (a hash of the text), and the tokens: as they are, as a template and bare."""
    found = docs.select("doc_id", F.xxhash64("text").alias("row"), marked(F.col("text")).alias("marked"))
    return found.select("doc_id", "row", F.split("marked", " ").alias("v"), templated(F.col("marked")).alias("t"), bared(F.col("marked")).alias("b"))


def document_windows(tokens: DataFrame, kinds: list[tuple[int, int]], carried: list[str]) -> DataFrame:
    """The carried columns and the place ``p``, the hash ``h`` and, in ``last``, the hash one place
    before of every window of each (kind, width)."""
    # the outer form keeps the optimiser from testing for empty arrays first, where it would work everything out again
    places = tokens.select("*", F.posexplode_outer("t").alias("p", "_"))
    at = lambda k, w, p: window_hash(k, w, "tb"[k], p)
    each = ", ".join(f"IF(p + {w} <= size(t), {at(k, w, 'p')}, NULL)" for k, w in kinds)
    windows = places.select(*dict.fromkeys([*carried, "t", "b", "p"]), F.posexplode_outer(F.expr(f"array({each})")).alias("i", "h"))
    last = "CASE i " + " ".join(f"WHEN {i} THEN IF(p > 0, {at(k, w, '(p - 1)')}, NULL)" for i, (k, w) in enumerate(kinds)) + " END"
    return windows.select(*carried, "p", "h", F.expr(last).alias("last"))


def _hits(docs: DataFrame, windows: DataFrame, broadcast: bool) -> DataFrame:
    """doc_id, row, pid, ``shift`` of the part against the document, and the tokens from ``start``
    on under and around it, for each match of a window whose predecessors don't match too."""
    kinds = [(r.kind, r.width) for r in windows.select("kind", "width").distinct().orderBy("kind", "width").collect()]  # at most 2 x WIDTH
    if not kinds:
        kinds = [(0, WIDTH)]
    tokens = _tokens(docs)
    fresh = "NOT coalesce(last = before, false)"  # else the window before lays the item just so
    if broadcast:
        found = document_windows(tokens, kinds, ["doc_id", "row", "v", "t"]).join(F.broadcast(windows), "h").where(fresh)
    else:
        slim = document_windows(tokens, kinds, ["doc_id", "row"]).join(windows, "h").where(fresh)
        slim = materialize(slim.select("doc_id", "row", "p", "pid", "q"), "hits")
        again = docs.select("doc_id", "text").distinct()
        have = slim.select(F.col("doc_id").alias("d"), F.col("row").alias("r")).distinct()
        again = again.join(have, F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("r")), "left_semi")
        whole = _tokens(again).select(F.col("doc_id").alias("d"), F.col("row").alias("r"), "v", "t")
        found = slim.join(whole, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")))
    found = found.withColumn("shift", F.expr("p - q")).withColumn("start", F.greatest(F.col("shift"), F.lit(0)))
    around = [F.expr(f"slice({c}, start + 1, {LEAD + STEP + 2 * TAIL})").alias(c) for c in ("v", "t")]
    return found.select("doc_id", "row", "pid", "shift", "start", *around)


def _runs(holds: str) -> str:
    """SQL for the runs of places k of ``same`` at which a condition holds: first place s and length n."""
    ends = f"concat(array(-1), filter(sequence(0, size(same) - 1), k -> NOT ({holds})), array(size(same)))"
    return f"flatten(transform(array({ends}), ends -> transform(sequence(1, size(ends) - 1), i -> struct(ends[i - 1] + 1 AS s, ends[i] - ends[i - 1] - 1 AS n))))"


def _slots(tokens: str) -> Column:
    """The distinct pairs of values that meet under slots of one kind."""
    return F.expr(f"array_distinct(transform(filter({tokens}, m -> m.a IN ('{NAME}', '{NUMBER}', '{UNIT}') AND m.a = m.b), m -> struct(m.x AS x, m.y AS y)))")


def leaking_texts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, row (a hash of the text), item_id, matched and n_tokens (of the item), share, and verbatim (all
    slots as in the item) of each text and item that it leaks."""
    parts = materialize(item_parts(benchmark), "item-parts")
    windows = materialize(item_windows(parts), "item-windows")
    parts = parts.drop("window_t").join(windows.select("pid").distinct(), "pid", "left_semi")
    n_windows, n_tokens = windows.count(), parts.agg(F.sum(F.size("item_v"))).first()[0] or 0
    hits = _hits(docs, windows, n_windows <= MOST_BROADCAST)
    both = hits.join(F.broadcast(parts) if n_tokens <= MOST_BROADCAST else parts, "pid")
    # the tokens of the item, each with what lies under it: 2 as it is, 1 the same kind of slot, 0 something else
    under = lambda c: f"IF(shift + k < 0, NULL, get({c}, shift + k - start))"
    tokens = F.expr(f"transform(sequence(0, size(item_t) - 1), k -> struct(item_t[k] AS a, {under('t')} AS b, item_v[k] AS x, {under('v')} AS y))")
    bare = lambda c: F.regexp_replace(c, "^" + _SLOT, "")
    same = F.transform("tok", lambda m: F.when(bare(m["x"]) == bare(m["y"]), 2).when(m["a"] == m["b"], 1).otherwise(0))
    overlay = ["doc_id", "row", "item", "item_id", "pid", "shift", "n_tokens", "lead", "own"]
    laid = both.select(*overlay, tokens.alias("tok")).withColumn("same", same)
    laid = laid.withColumn("stretches", F.expr(f"filter({_runs('same[k] > 0')}, r -> r.n >= least({WIDTH}, n_tokens))"))
    fits = lambda c: F.size(c) == F.size(F.array_distinct(F.transform(c, lambda s: s["x"])))
    laid = laid.withColumns({"fits": fits(_slots("tok")), "fits_within": fits(_slots("flatten(transform(stretches, r -> slice(tok, r.s + 1, r.n)))"))})
    counted = "same[k] = 2 OR same[k] = 1 AND (fits OR fits_within AND exists(stretches, r -> k >= r.s AND k < r.s + r.n))"
    laid = laid.select(*overlay, "same", "fits", F.expr(f"transform(sequence(0, size(same) - 1), k -> {counted})").alias("counted")).withColumn("runs", F.expr(_runs("counted[k]")))
    pieces = f"aggregate(filter(runs, r -> r.n >= {LEAST_LITERALS}), 0, (n, r) -> n + greatest(0, least(r.s + r.n, lead + own) - greatest(r.s, lead)))"
    matched = F.expr(f"CAST(CASE WHEN fits THEN size(filter(slice(same, lead + 1, own), e -> e > 0)) ELSE {pieces} END AS BIGINT)")
    as_is = F.expr("NOT exists(sequence(0, size(same) - 1), k -> counted[k] AND same[k] = 1)")
    laid = laid.select(*overlay, matched.alias("matched"), F.expr("array_max(transform(runs, r -> r.n))").alias("longest"), as_is.alias("as_is"))
    most = [F.max("longest").alias("longest"), F.min("as_is").alias("as_is"), F.max("n_tokens").alias("n_tokens")]
    item = ["doc_id", "row", "item", "item_id"]
    per_shift = laid.groupBy(*item, "pid", "shift").agg(F.max("matched").alias("matched"), F.max("own").alias("own"), *most)
    per_part = per_shift.groupBy(*item, "pid").agg(F.least(F.sum("matched"), F.max("own")).alias("matched"), *most)
    per_item = per_part.groupBy(*item).agg(F.sum("matched").alias("matched"), *most)
    share = F.col("matched") / F.col("n_tokens")
    leaks = per_item.where((share >= LEAST_SHARE) | (F.col("longest") >= LEAST_RUN))
    return leaks.select("doc_id", "row", "item_id", "matched", "n_tokens", share.alias("share"), F.col("as_is").alias("verbatim"))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, and the best match: matched, n_tokens, share and verbatim."""
    best = F.max(F.struct("share", "matched", "n_tokens", "verbatim"))
    leaks = leaking_texts(docs, benchmark).groupBy("doc_id", "item_id").agg(best.alias("b"))
    return leaks.select("doc_id", "item_id", "b.matched", "b.n_tokens", "b.share", "b.verbatim")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents whose text leaks no item, all their columns; others of the same id stay."""
    leaks = materialize(leaking_texts(docs, benchmark).select("doc_id", "row").distinct(), "leaking-texts")
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["doc_id"]) & (F.xxhash64(docs["text"]) == leaks["row"]), "left_anti")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
