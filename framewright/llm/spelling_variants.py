"""Words grouped with their spelling variants: one inserted, deleted or replaced code point apart.

1. Words are counted in one pass over the texts, on the bytes of whole blocks; each task adds up before it shuffles.
2. Every word gives an integer key for itself and one for each of its deletions (:func:`deletion_keys`).  A
   deletion's key comes from the polynomial hashes of the prefix before and the suffix after the left-out
   place, both differences of running sums, so all keys of a block of words are a few numpy operations, and
   a word of k letters costs k keys, not k strings.
3. Keys are dealt out by their upper bits and sorted.  Words that differ by a replacement at place i share the key of
   that deletion at i; a word one shorter has itself the key of the longer one's deletion (of equal letters in a
   row only the last is left out for that).  One walk over the sorted keys keeps the rows that share.
4. Only those rows meet their words again, and are grouped by the strings that are left, so keys that
   collide never link words.  Words that share a deletion and its place differ in one code point, so there are at most as many
   as letters; their best and second best are found in a window and no pair is ever listed.

A word's form is its near word of largest count if that is ``ratio`` times its own at least, so counts rise along
forms and a chain has at most log_ratio(count) steps; roots are found by pointer jumping.

Null texts and empty ones have no words; a null doc_id counts as an empty number in the hash; repeated rows count each time;
texts are read whole, and words may be of any length; an empty table gives no words.  Only
doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright.llm import words as W
from framewright.storage import materialize, table

LEAST_CHARS, LEAST_COUNT = 6, 5
#: One in so many occurrences loses a letter.
NOISE = 199
RATIO = 5
#: Different words that a task holds before it hands on their counts.
MOST_WORDS = 300_000
#: Words of up to so many bytes have their checksums worked out together.
SHORT = 64
#: Rows handed on together, and bytes of a text that are read together.
ROWS, STRETCH = 1 << 16, 1 << 22

# U+00C0 to U+00FF are the byte C3 and one that follows it; no other character has a C3.
_LEAD = 0xC3
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123), _LEAD]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_steps() -> np.ndarray:
    """What a byte of the CRC-32 register becomes, by the polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_STEPS = _crc_steps()


def word_runs(texts: list[bytes], least: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The text and the lower-cased letters of each run of at least so many code points: place of the text,
    different words, and which of them each run is."""
    buf, at = W.text_bytes(texts)
    letter = _IS_LETTER[buf]
    lead = buf == _LEAD
    letter[1:] |= lead[:-1]
    edge = np.flatnonzero(np.diff(letter, prepend=False))  # a newline ends the last text
    starts, ends = edge[0::2], edge[1::2]
    leads = W.running(lead)
    long_enough = ends - starts - (leads[ends] - leads[starts]) >= least
    starts, ends = starts[long_enough], ends[long_enough]
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    flat = _LOWER[buf[np.cumsum(inside[:-1]).astype(bool)]]
    runs = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(W.running(ends - starts)), pa.py_buffer(flat)]).dictionary_encode()
    return np.searchsorted(at, starts, side="right") - 1, runs.dictionary, runs.indices.to_numpy()


def checksums(owner: np.ndarray, prefixes: list[bytes], words: list[bytes], which: np.ndarray) -> np.ndarray:
    """CRC-32 of each run behind its text's prefix.  The checksum of two parts is that of the first, moved on by as many
    zero bytes as the second has, xor that of the second; so prefixes are moved on once for each length."""
    before = np.fromiter(map(zlib.crc32, prefixes), np.uint32, len(prefixes))
    size = np.fromiter(map(len, words), np.int64, len(words))
    own = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    moved = [before]
    for _ in range(min(SHORT, int(size.max(initial=0)))):
        moved.append((moved[-1] >> np.uint32(8)) ^ _STEPS[moved[-1] & np.uint32(255)])
    of = size[which]
    out = np.stack(moved)[np.minimum(of, len(moved) - 1), owner] ^ own[which]
    for k in np.flatnonzero(of > SHORT).tolist():
        out[k] = zlib.crc32(words[which[k]], int(before[owner[k]]))
    return out


def stretches(doc_ids: list, texts: list[bytes]) -> Iterator[tuple[list, list[bytes]]]:
    """The texts, long ones cut behind spaces into stretches of their own."""
    if sum(map(len, texts)) <= STRETCH:
        yield doc_ids, texts
        return
    for i, text in zip(doc_ids, texts, strict=True):
        at = 0
        while at < len(text):
            stop = text.find(b" ", at + STRETCH) + 1 or len(text)
            yield [i], [text[at:stop]]
            at = stop


def count_words(docs: DataFrame, least_chars: int = LEAST_CHARS, noise: int = NOISE) -> DataFrame:
    """``word`` and ``n``, how often it occurs, after one code point has been left out of those runs whose checksum
    ``noise`` divides (0: of none)."""

    def partial(counts: Counter) -> Iterator[pa.RecordBatch]:
        words = list(counts)
        for k in range(0, len(words), ROWS):
            part = words[k : k + ROWS]
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in part], pa.string()), pa.array([counts[w] for w in part], pa.int64())], ["word", "n"])
        counts.clear()

    def add(counts: Counter, doc_ids: list, texts: list[bytes]) -> None:
        owner, different, which = word_runs(texts, least_chars)
        words = different.to_pylist()
        if noise:
            h = checksums(owner, [f"{'' if i is None else i}:".encode() for i in doc_ids], words, which)
            hit = h % noise == 0
            for k, x in zip(which[hit].tolist(), h[hit].tolist(), strict=True):
                word = words[k].decode()
                i = x % len(word)
                if len(word) > least_chars:
                    counts[(word[:i] + word[i + 1 :]).encode()] += 1
            which = which[~hit]
        n = np.bincount(which, minlength=len(words))
        for k in np.flatnonzero(n).tolist():
            counts[words[k]] += int(n[k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in W.blocks(batch, "text"):
                for doc_ids, texts in stretches(part.column("doc_id").to_pylist(), [(t or "").encode() for t in part.column("text").to_pylist()]):
                    add(counts, doc_ids, texts)
                if len(counts) > MOST_WORDS:
                    yield from partial(counts)
        yield from partial(counts)

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def deletion_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word (its place), the key of itself (``pos`` -1) and of what is left without the code point at each
    place, and whether another code point follows that one."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    at = W.running(size)
    owner = np.repeat(np.arange(len(words)), size)
    begin, end, here = at[owner], at[owner + 1], np.arange(len(codes))
    of_word, of_rest = [], []
    for base in W.BASES[:2]:
        sums = W.running(W.residue((codes + np.uint64(1)) * W._prime_powers(base, int(size.max(initial=0)))[here - begin]))
        of_word.append(W.residue(sums[at[1:]] - sums[at[:-1]]))
        prefix, suffix = W.residue(sums[here] - sums[begin]), W.residue(sums[end] - sums[here + 1])
        of_rest.append(W.residue(prefix + W.residue(suffix * np.uint64(pow(base, -1, W.PRIME)))))
    key = [W.mix(a | b << np.uint64(31)).view(np.int64) for a, b in (of_word, of_rest)]
    last = here == end - 1
    last[:-1] |= codes[1:] != codes[:-1]
    return np.concatenate([np.arange(len(words)), owner]), np.concatenate(key), np.concatenate([np.full(len(words), -1), here - begin]).astype(np.int32), np.concatenate([np.zeros(len(words), bool), last])


def _keyed(vocabulary: DataFrame) -> DataFrame:
    """key, pos, last and id of every word and deletion."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.blocks(batch, "word"):
                word, key, pos, last = deletion_keys(part.column("word").to_pylist())
                rows = pa.RecordBatch.from_arrays([pa.array(key), pa.array(pos), pa.array(last), part.column("id").take(pa.array(word))], ["key", "pos", "last", "id"])
                for k in range(0, rows.num_rows, ROWS):
                    yield rows.slice(k, ROWS)

    return vocabulary.select("id", "word").mapInArrow(run, "key long, pos int, last boolean, id long")


def _sharing(key: np.ndarray, pos: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which of the sorted rows of whole keys share: with an equal place, or a word with a deletion."""
    new_key = np.diff(key, prepend=key[0] ^ 1) != 0
    run = np.cumsum(new_key) - 1
    place = np.cumsum(new_key | (np.diff(pos, prepend=-2) != 0)) - 1
    own = pos < 0
    has_word = np.bincount(run, own) > 0
    has_deletion = np.bincount(run, last) > 0
    return ~own & (np.bincount(place)[place] > 1) | own & has_deletion[run] | last & has_word[run]


def _shared(keyed: DataFrame) -> DataFrame:
    """The rows that share a key in a way that may make words near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(rows: pa.RecordBatch) -> pa.RecordBatch:
            return rows.filter(pa.array(_sharing(*(rows.column(c).to_numpy(zero_copy_only=False) for c in ("key", "pos", "last")))))

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            if held and held[-1].column("key")[-1].as_py() == key[-1]:
                held.append(batch)
                continue
            cut = int(np.searchsorted(key, key[-1]))  # rows of the last key wait for more of it
            held.append(batch.slice(0, cut))
            if whole := [b for b in held if b.num_rows]:
                yield out(pa.Table.from_batches(whole).combine_chunks().to_batches()[0])
            held = [batch.slice(cut)]
        if held:
            yield out(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    dealt = keyed.repartition(F.shiftright("key", 48)).sortWithinPartitions("key", "pos", "id")
    return dealt.mapInArrow(run, "key long, pos int, last boolean, id long")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """id, ``n_near`` and ``best`` (the most frequent near word, the least of equals, as less its count and the word)
    of the words that have near ones; ``vocabulary``: id (unique), word and n."""
    rows = _shared(_keyed(vocabulary)).join(vocabulary.select("id", "word", "n"), "id")
    rest = F.expr("CASE WHEN pos < 0 THEN word ELSE concat(substring(word, 1, pos), substring(word, pos + 2)) END")
    rows = rows.withColumns({"rest": rest, "me": F.struct((-F.col("n")).alias("less"), "word")})
    same_rest, same_place = Window.partitionBy("key", "rest"), Window.partitionBy("key", "rest", "pos")
    ranked = same_place.orderBy("me")
    rows = rows.withColumns({
        "word_here": F.max(F.when(F.col("pos") < 0, F.col("me"))).over(same_rest),
        "n_longer": F.count_if("last").over(same_rest),
        "best_longer": F.min(F.when(F.col("last"), F.col("me"))).over(same_rest),
        "n_same": F.when(F.col("pos") >= 0, F.count("*").over(same_place) - 1).otherwise(0),
        "best_same": F.when(F.col("pos") >= 0, F.when(F.row_number().over(ranked) == 1, F.lead("me").over(ranked)).otherwise(F.min("me").over(same_place))),
    })
    shorter = F.col("last") & F.col("word_here").isNotNull()
    near = F.col("n_same") + F.when(F.col("pos") < 0, F.col("n_longer")).when(shorter, 1).otherwise(0)
    best = F.least("best_same", F.when(F.col("pos") < 0, F.col("best_longer")).when(shorter, F.col("word_here")))
    return rows.select("id", near.alias("near"), best.alias("best")).groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best")).where("n_near > 0")


def _roots(forms: DataFrame) -> DataFrame:
    """word and ``root`` of words with a form: the last word that forms lead to."""
    found = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if found.join(on, "root", "left_semi").isEmpty():
            return found
        found = materialize(found.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")


def group_variants(counts: DataFrame, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of the words that occur ``least_count`` times; ``counts``: word (unique) and n."""
    vocabulary = materialize(counts.where(F.col("n") >= least_count).select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")
    near = vocabulary.join(near_words(vocabulary), "id", "left")
    form_n = -F.col("best")["less"]
    formed = F.coalesce(form_n >= ratio * F.col("n"), F.lit(False))
    named = materialize(near.select("word", F.when(formed, F.col("best")["word"]).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, form_n).alias("form_n")), "forms")
    roots = _roots(named.where("form IS NOT NULL"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(count_words(table(spark, sf_dir, "documents")))


ORACLE = """
WITH RECURSIVE steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
lowered AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
  FROM runs WHERE length(run) >= 6 GROUP BY ALL),
coded AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM lowered),
summed AS (
  SELECT run, c, xor(list_reduce(list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT)),
                             lambda r, b: xor(r >> 8, t[(xor(r, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM coded, steps),
spelled AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, c
  FROM summed),
vocabulary AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
places AS (SELECT word, n, unnest(range(length(word))) AS pos FROM vocabulary),
deletions AS (SELECT word, n, pos, substr(word, 1, pos) || substr(word, pos + 2) AS rest FROM places),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM deletions a JOIN deletions b ON a.rest = b.rest AND a.pos = b.pos AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM deletions d JOIN vocabulary v ON d.rest = v.word
  UNION SELECT v.word, d.word, d.n FROM deletions d JOIN vocabulary v ON d.rest = v.word),
best AS (
  SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS rn FROM near),
formed AS (
  SELECT v.word, v.n, CAST(coalesce(b.n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN b.other_n >= 5 * v.n THEN b.other END AS form, CASE WHEN b.other_n >= 5 * v.n THEN b.other_n END AS form_n
  FROM vocabulary v LEFT JOIN best b ON v.word = b.word AND b.rn = 1),
chain AS (
  SELECT word, coalesce(form, word) AS at, form IS NULL AS done FROM formed
  UNION ALL SELECT c.word, coalesce(f.form, f.word), f.form IS NULL FROM chain c JOIN formed f ON c.at = f.word WHERE NOT c.done)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON f.word = c.word AND c.done
"""
