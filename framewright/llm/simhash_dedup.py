"""SimHash fingerprints, and the groups of documents whose fingerprints nearly agree.

1. Words in lower case (A-Z), shingles of ``width`` words with repeats, XXH64 with seed 42; a
   bit of the fingerprint is 1 if it is set in over half of the hashes.  Texts with fewer words
   give one shingle of all of them; texts without a word have fingerprint zero.
2. Only distinct fingerprints go on, so any number of copies counts once.  The 64 bits are
   split into blocks, radius + s of them; two fingerprints within the radius agree on s blocks
   at least, so every choice of s blocks is a key.  s grows with the number of
   fingerprints (:func:`blocking`), which keeps the runs of equal keys short; the result
   is exact for each s.
3. A run is compared by bit planes: 64 fingerprints make one word a plane; a query
   XORs its bit with the word, full adders count 64 distances at once in carry-save
   form, and words all of whose lanes exceed the radius are abandoned.  A run longer than
   four times that is cut in tiles by hash, and every pair of tiles is a group of its own.
4. Each group answers with the spanning edges of its links (at most one an entry), and
   the components of these edges are found by contraction.

:func:`near_groups` finds near duplicates by similarity instead: texts whose sets of shingles have a
Jaccard similarity of ``NEAR`` or more.  Such fingerprints differ in about 10 bits, too many for keys of
equal blocks, so keys come from ``BANDS`` bands of ``BAND`` minimum hashes of the same shingles, of which two
texts of similarity 0.8 share one in 999 of 1000 cases.  Those that share a key are compared by bit
planes within ``NEAR_BITS`` and then by an estimate of the similarity from 256 ranges of hashes, whose cut
``MAYBE`` lies four standard errors below 0.8.  Of what passes, each group of a key names pairs that would connect it
(a spanning forest), and these are judged by the similarity of the two whole sets.  Groups of
which a pair fails are compared once more, with the sets at hand and each pair judged, so no link is lost.

Null texts count as texts without a word, and all those link.  Repeated rows share their
component.  Null doc_ids take part; component_id is the smallest doc_id that is not null.
Columns other than doc_id and text are not read.  Groups of a key are quadratic in its *different*
texts (copies count once), 64 comparisons an operation.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import words as W
from framewright.components import connected_components
from framewright.llm.ragged import offsets
from framewright.storage import materialize, table

WIDTH = 4
RADIUS = 4
SEED = 42
BIN_ROWS = 30_000
LONGEST_RUN = 512
MOST_BROADCAST = 20_000
BINS = 256
BAND = 6
BANDS = 24
NEAR = 0.8
MAYBE = 0.7
NEAR_BITS = 26
NEAR_RUN = 4096
PAIRS = 1 << 15
HASHES = 1 << 16

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes, width: int) -> list[int]:
    words = text.lower().split()
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(flat, SEED)] if words else []
    starts = np.append(0, ends[:-1] + 1)[: len(words) - width + 1]
    digest = xxhash.xxh64_intdigest
    return [digest(flat[a:b], SEED) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist(), strict=True)]


def fingerprints(each: list[np.ndarray]) -> np.ndarray:
    """An unsigned 64-bit fingerprint of each array of hashes."""
    sizes = np.fromiter(map(len, each), np.int64, len(each))
    hashes = np.concatenate([np.zeros(0, np.uint64), *each])
    owner = np.repeat(np.arange(len(each)), sizes)
    ones = np.zeros((len(each), 64), np.int64)
    for k in range(0, len(hashes), HASHES):
        bits = np.unpackbits(hashes[k : k + HASHES].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[k : k + HASHES]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        ones[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def sketches(each: list[np.ndarray]) -> np.ndarray:
    """For each array of hashes a byte of the least hash in each of ``BINS`` ranges, 0 if none falls there."""
    hashes = np.concatenate([np.zeros(0, np.uint64), *each])
    owner = np.repeat(np.arange(len(each)), np.fromiter(map(len, each), np.int64, len(each)))
    least = np.full((len(each), BINS), _ALL)
    np.minimum.at(least, (owner, (hashes >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)), hashes)
    return np.where(least == _ALL, 0, 1 + least % 255).astype(np.uint8)


#: Multipliers of the minimum hashes: any odd numbers do, as long as they stay the same.
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(each: list[np.ndarray]) -> np.ndarray:
    """``BANDS`` keys of each array of hashes: each over ``BAND`` minimum hashes (0 of an empty array)."""
    sizes = np.fromiter(map(len, each), np.int64, len(each))
    full = np.flatnonzero(sizes)
    least = np.zeros((len(each), BANDS * BAND), np.uint64)
    if len(full):
        hashes, first = np.concatenate([each[i] for i in full]), offsets(sizes[full])[:-1]
        for k, factor in enumerate(_FACTORS):
            least[full, k] = np.minimum.reduceat(hashes * factor, first)
    bands = W.mix(least).reshape(len(each), BANDS, BAND)
    return W.mix((bands * W.powers(W.WORD_BASE, BAND)).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def fingerprint_documents(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.blocks(batch, "text"):
                each = [np.array(shingle_hashes((t or "").encode(), width), np.uint64) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fingerprints(each).view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    return [np.unique(np.array(shingle_hashes((t or "").encode(), width), np.uint64)) for t in texts]


def sketch_documents(rows: DataFrame, width: int) -> DataFrame:
    """The rows' columns but ``text``, and ``node`` (equal for equal sets of shingles), ``fp``, ``sketch`` and
    ``bands`` of the set."""
    names = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.blocks(batch, "text"):
                each = shingle_sets(part.column("text").to_pylist(), width)
                node = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in each], np.uint64).view(np.int64)
                columns = [pa.array(node), pa.array(fingerprints(each).view(np.int64)), pa.array([x.tobytes() for x in sketches(each)], pa.binary()), pa.array(list(band_keys(each).view(np.int64)), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *columns], [*names, "node", "fp", "sketch", "bands"])

    schema = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in names)
    return rows.mapInArrow(run, schema + "node long, fp long, sketch binary, bands array<long>")


def blocking(n: int, radius: int, longest_run: int = LONGEST_RUN) -> list[int]:
    """Masks over the 64 bits: fingerprints within the radius agree under one of them at least.
    Enough blocks that a run of equal keys would have about ``longest_run`` of n even fingerprints."""
    for n_blocks in range(radius + 1, 65):
        same = n_blocks - radius
        if n / 2 ** (64 * same // n_blocks) <= longest_run or n_blocks >= radius + 4:
            break
    edge = [64 * i // n_blocks for i in range(n_blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edge[:-1], edge[1:], strict=True)]
    return [sum(block[i] for i in chosen) for chosen in combinations(range(n_blocks), same)]


def _full_adder(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


class Planes:
    """Fingerprints in runs, stored by bit planes; each run starts a new word."""

    def __init__(self, fps: np.ndarray, runs: np.ndarray):
        sizes = np.diff(runs)
        self.fps = fps
        self.word_at = offsets((sizes + 63) // 64)
        run = np.repeat(np.arange(len(sizes)), sizes)
        self.place = np.arange(len(fps)) - runs[run]
        self.own_word = self.word_at[run] + self.place // 64
        self.last_word = self.word_at[run + 1]
        word_run = np.repeat(np.arange(len(sizes)), np.diff(self.word_at))
        self.word_row = runs[word_run] + 64 * (np.arange(self.word_at[-1]) - self.word_at[word_run])
        lane = self.own_word * 64 + self.place % 64
        self.planes = np.zeros((64, self.word_at[-1]), np.uint64)
        bits = np.zeros(self.word_at[-1] * 64, bool)
        for b in range(64):
            bits[lane] = (fps >> np.uint64(b)) & np.uint64(1)
            self.planes[b] = np.packbits(bits, bitorder="little").view("<u8")
        bits[:] = False
        bits[lane] = True
        self.taken = np.packbits(bits, bitorder="little").view("<u8")

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows within the radius of each other, each pair of one run once."""
        n_words = self.last_word - self.own_word
        total = offsets(n_words)
        for k in range(0, int(total[-1]), PAIRS):
            pair = np.arange(k, min(k + PAIRS, int(total[-1])))
            query = np.searchsorted(total, pair, side="right") - 1
            word = self.own_word[query] + pair - total[query]
            out = ~self.taken[word]
            # lanes up to the query's own are another query's pairs
            own = word == self.own_word[query]
            lane = (self.place[query] % 64).astype(np.uint64)
            out[own] |= _ALL >> (np.uint64(63) - lane[own])
            yield from self._near(query, word, out, radius)

    def _near(self, query: np.ndarray, word: np.ndarray, out: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Counters of 1, 2, 4, ... differing bits in 64 lanes a word; ``out``: lanes that exceed."""
        value = self.fps[query]
        c = [np.zeros(len(word), np.uint64) for _ in range(max(2, radius.bit_length()))]
        for b in range(0, 64, 4):
            d = [self.planes[i][word] ^ (np.uint64(0) - ((value >> np.uint64(i)) & np.uint64(1))) for i in range(b, b + 4)]
            c[0], t1 = _full_adder(c[0], d[0], d[1])
            c[0], t2 = _full_adder(c[0], d[2], d[3])
            c[1], carry = _full_adder(c[1], t1, t2)
            for i in range(2, len(c)):
                c[i], carry = c[i] ^ carry, c[i] & carry
            out = out | carry | _exceeds(c, radius)
            if b % 8 == 4:
                live = out != _ALL
                if not live.all():
                    query, word, value, out, *c = (x[live] for x in (query, word, value, out, *c))
                if not len(word):
                    return
        hit = np.flatnonzero(np.unpackbits((~out).astype("<u8").view(np.uint8), bitorder="little"))
        yield query[hit // 64], self.word_row[word[hit // 64]] + hit % 64


def _exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count, as far as the counters go, is over the radius."""
    over, same = np.zeros_like(counters[0]), np.full_like(counters[0], _ALL)
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            same = same & counters[i]
        else:
            over = over | (same & counters[i])
            same = same & ~counters[i]
    return over


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Links rows a and b: changes the labels (each the least row of a component) and returns which
    of the pairs did it.  In each round every label takes one pair to a lesser label."""
    used = [np.zeros(0, np.int64)]
    at = np.arange(len(a))
    while True:
        x, y = labels[a[at]], labels[b[at]]
        at, x, y = (v[x != y] for v in (at, x, y))
        if not len(at):
            return np.concatenate(used)
        upper, first = np.unique(np.maximum(x, y), return_index=True)
        used.append(at[first])
        labels[upper] = np.minimum(x, y)[first]
        while True:
            above = labels[labels]
            if (above == labels).all():
                break
            labels[:] = above


def resembles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rows of two arrays of sketches whose estimated Jaccard similarity reaches ``MAYBE``."""
    same = ((x == y) & (x != 0)).sum(axis=1)
    return same >= MAYBE * ((x != 0) | (y != 0)).sum(axis=1)


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets, as ascending arrays, reaches ``NEAR``."""
    if min(len(x), len(y)) < NEAR * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared >= NEAR * (len(both) - shared)


def group_edges(group: np.ndarray, fps: np.ndarray, radius: int, sketch: np.ndarray | None = None, roots: np.ndarray | None = None, sets: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that connect, within each group, what links connect.  With sketches only pairs count
    that resemble each other; with sets and ``roots`` (what is connected already) those that are similar."""
    order = np.argsort(group, kind="stable")
    group, fps = group[order], fps[order]
    runs = np.append(np.flatnonzero(np.diff(group, prepend=group[0] - 1)), len(group))
    alone = np.repeat(np.diff(runs) == 1, np.diff(runs))
    order, group, fps = order[~alone], group[~alone], fps[~alone]
    if not len(fps):
        return order, order
    runs = np.append(np.flatnonzero(np.diff(group, prepend=group[0] - 1)), len(group))
    labels = np.arange(len(fps))
    if roots is not None:
        run = np.repeat(np.arange(len(runs) - 1), np.diff(runs))
        by = np.lexsort((labels, roots[order], run))
        first = np.flatnonzero((np.diff(roots[order][by], prepend=0) != 0) | (np.diff(run[by], prepend=-1) != 0))
        labels[by] = np.repeat(by[first], np.diff(np.append(first, len(by))))
    found = [np.zeros((0, 2), np.int64)]
    for a, b in Planes(fps, runs).links(radius):
        for k in range(0, len(a), PAIRS if sketch is not None else max(len(a), 1)):
            i, j = a[k : k + PAIRS] if sketch is not None else a, b[k : k + PAIRS] if sketch is not None else b
            open_ = labels[i] != labels[j]
            i, j = i[open_], j[open_]
            if sketch is not None:
                near = resembles(sketch[order[i]], sketch[order[j]])
                i, j = i[near], j[near]
            if sets is None:
                used = join_labels(labels, i, j)
                found.append(np.stack([i[used], j[used]], axis=1))
                continue
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                if labels[x] != labels[y] and similar(sets[order[x]], sets[order[y]]):
                    one = np.array([[x, y]])
                    join_labels(labels, one[:, 0], one[:, 1])
                    found.append(one)
    pairs = order[np.concatenate(found)]
    return pairs[:, 0], pairs[:, 1]


def _tiled(rows: DataFrame) -> DataFrame:
    """node and ``grp`` of rows node, key, tiles: those of a key are cut in that many tiles by hash, and
    every pair of tiles is a group of its own."""
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    rows = rows.select("node", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    return rows.select("node", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("grp"))


def _compared(rows: DataFrame, n_rows: int, radius: int, bin_rows: int = BIN_ROWS) -> DataFrame:
    """Edges ``a``, ``b`` and their group of n_rows rows ``node``, ``grp``, ``fp`` (and ``sketch``; and ``root``, ``shingles``),
    several groups a task."""
    extra = [c for c in ("sketch", "root", "shingles") if c in rows.columns]
    rows = rows.select("node", "grp", "fp", *extra).withColumn("bin", F.pmod("grp", F.lit(max(16, -(-n_rows // bin_rows)))))

    def run(held: pa.Table) -> pa.Table:
        held = held.sort_by("node")  # so that groups of the same nodes name the same pairs
        node, grp = (held.column(c).to_numpy() for c in ("node", "grp"))
        given = {}
        if "sketch" in extra:
            given["sketch"] = np.frombuffer(b"".join(held.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
        if "shingles" in extra:
            given |= {"roots": held.column("root").to_numpy(), "sets": [np.sort(x.values.to_numpy().view(np.uint64)) for x in held.column("shingles")]}
        a, b = group_edges(grp, held.column("fp").to_numpy().view(np.uint64), radius, **given)
        return pa.table({"a": node[a], "b": node[b], "grp": grp[a]})

    return rows.groupBy("bin").applyInArrow(run, "a long, b long, grp long")


def similar_edges(distinct: DataFrame, n: int, radius: int, longest_run: int = LONGEST_RUN) -> DataFrame:
    """Edges ``a``, ``b`` that connect what fingerprints ``fp``, n different ones, link within the radius."""
    masks, tile = blocking(n, radius, longest_run), 4 * longest_run
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.explode(F.array(*(F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(m))) for t, m in enumerate(signed)))).alias("key")
    rows = distinct.select(F.col("fp").alias("node"), keys)
    hot = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > tile)
    hot = materialize(hot.select("key", "n", F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "hot-keys")
    n_hot, more = hot.agg(F.count("*"), F.sum(F.col("n") * (F.col("tiles") - 1))).first()
    hot = hot.drop("n")
    if n_hot <= MOST_BROADCAST:  # else a shuffled join, whose hot keys adaptive execution splits
        hot = F.broadcast(hot)
    tiled = _tiled(rows.join(hot, "key", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1))))
    return _compared(tiled.withColumn("fp", F.col("node")), n * len(masks) + (more or 0), radius).select("a", "b").distinct()


def _sets_of(nodes: DataFrame, first: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """node and ``shingles``, the set in ascending order, of some nodes, from the text of each one's first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.blocks(batch, "text"):
                each = shingle_sets(part.column("text").to_pylist(), width)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([x.view(np.int64) for x in each], pa.list_(pa.int64()))], ["node", "shingles"])

    # the nodes grow with the corpus, so they are never broadcast
    wanted = first.join(nodes, "node", "left_semi").select("node", *ROW)
    texts = rows.select(*ROW, "text").join(wanted.hint("merge"), ROW).select("node", "text")
    return materialize(texts.mapInArrow(run, "node long, shingles array<long>").dropDuplicates(["node"]), "sets")


def _similar_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with ``ok``: whether their sets are similar."""
    of = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").withColumn("n", F.size(F.array_intersect("sa", "sb")))
    return both.select("a", "b", (F.col("n") >= NEAR * (F.size("sa") + F.size("sb") - F.col("n"))).alias("ok"))


def near_edges(rows: DataFrame, distinct: DataFrame, width: int, longest_run: int = NEAR_RUN) -> DataFrame:
    """Edges ``a``, ``b`` of nodes that connect what is similar.  ``rows``: the columns ``ROW`` and text of all
    documents; ``distinct``: node, one of its rows, ``fp``, ``sketch`` and ``bands``."""
    tile = 4 * longest_run
    keys = distinct.select("node", F.explode("bands").alias("key"))
    # most keys occur once, and rows of these go no further
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(shared.select("key", "n", F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "shared-keys")
    n_rows = shared.agg(F.sum(F.col("n") * F.col("tiles"))).first()[0] or 0
    tiled = materialize(_tiled(keys.join(shared.drop("n"), "key")), "tiled")
    sketched = tiled.join(distinct.select("node", "fp", "sketch"), "node")
    named = materialize(_compared(sketched, n_rows, NEAR_BITS), "pairs")
    pairs = named.select("a", "b").distinct()
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), distinct, rows, width)
    judged = materialize(_similar_pairs(pairs, sets), "judged")
    good = judged.where("ok").select("a", "b")
    failed = materialize(named.join(judged.where("NOT ok"), ["a", "b"]).select("grp").distinct(), "failed-groups")
    if failed.isEmpty():
        return good
    again = materialize(tiled.join(failed, "grp", "left_semi"), "again")
    rest = again.select("node").distinct().join(sets, "node", "left_anti").select("node")
    sets = sets.union(_sets_of(rest, distinct, rows, width))
    root = connected_components(good)
    again_rows = again.join(distinct.select("node", "fp", "sketch"), "node").join(root, "node", "left").withColumn("root", F.coalesce("root", F.xxhash64("node"))).join(sets, "node")
    return good.union(_compared(again_rows, again.count(), NEAR_BITS, BIN_ROWS // 16).select("a", "b"))


def _named(prints: DataFrame, distinct: DataFrame, edges: DataFrame) -> DataFrame:
    """doc_id, ``fp`` and ``component_id`` of documents, given edges between fingerprints."""
    root = connected_components(edges).withColumnRenamed("node", "fp")
    member = materialize(distinct.join(root, "fp", "left").select("fp", "first_id", F.coalesce("root", F.xxhash64("fp")).alias("root")), "members")
    least = materialize(member.groupBy("root").agg(F.min("first_id").alias("component_id")), "components")
    named = materialize(member.join(least, "root").select("fp", "component_id"), "named")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def link_documents(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS, longest_run: int = LONGEST_RUN) -> DataFrame:
    """doc_id, ``fp`` and ``component_id``, the smallest doc_id that links reach."""
    prints = materialize(fingerprint_documents(docs, width), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    return _named(prints, distinct, similar_edges(distinct, distinct.count(), radius, longest_run))


#: What names a row: hashes of its id and text together and of its text.
ROW = ["__row", "__text"]


def with_row(docs: DataFrame, names: list[str] = ROW) -> DataFrame:
    """The documents with what ``ROW`` holds in columns of these names: equal for equal ids and texts only."""
    return docs.withColumns(dict(zip(names, (F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull()), F.xxhash64(F.lit("text"), "text")), strict=True)))


def near_groups(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, ``ROW`` and ``root`` of every document: equal roots for those that near duplicates connect."""
    rows = with_row(docs.select("doc_id", "text"))
    prints = materialize(sketch_documents(rows, width), "sketches")
    # of a node's documents that of the smallest id, nulls last, stands for it
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW)).alias("r")
    distinct = prints.groupBy("node").agg(first, *(F.first(c).alias(c) for c in ("fp", "sketch", "bands")))
    distinct = materialize(distinct.select("node", *(F.col("r")[c].alias(c) for c in ROW), "fp", "sketch", "bands"), "distinct-sketches")
    root = connected_components(near_edges(rows, distinct, width))
    return prints.select("doc_id", *ROW, "node").join(root, "node", "left").select("doc_id", *ROW, F.coalesce("root", F.xxhash64("node")).alias("root"))


def link_near(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id and ``component_id``, the smallest doc_id that near duplicates reach."""
    grouped = materialize(near_groups(docs, width), "near-groups")
    return grouped.join(grouped.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select("doc_id", "component_id")


def drop_near(docs: DataFrame, width: int = 5) -> DataFrame:
    """One document of each group, all its columns: that of the smallest id (nulls last), of the smallest
    hash of the text among those; of rows with its id and text that of the least other columns, of which those
    that hold maps are compared as JSON.  Columns of any name stay the user's."""
    grouped = near_groups(docs, width)
    best = grouped.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__text", "__row")).alias("best"))
    free = max(docs.columns, key=len)  # longer than any of theirs
    names = [f"{free}{c}" for c in ROW]
    kept = materialize(best.select(*(F.col("best")[c].alias(n) for c, n in zip(ROW, names, strict=True))), "kept-rows")
    # rows of one id and text meet in a shuffle of the texts by these names, which the join uses too
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    order = [F.to_json(f"`{c}`") if "map<" in t else F.col(f"`{c}`") for c, t in docs.dtypes]
    one = F.min_by(whole, F.struct(*order)) if any("map<" in t for _, t in docs.dtypes) else F.min(whole)
    return with_row(docs, names).join(kept, names, "left_semi").groupBy(*names).agg(one.alias("all")).select("all.*")


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_documents(table(spark, sf_dir, "documents"))
    return linked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
