"""A text quality score learned from positives and unlabelled text.

Trusted positives are labelled 1 and lie outside the held-out fold (crc32 of the doc_id as
text, modulo 5, is 0 there); unlabelled rows are all documents outside it, their labels unread.
With the class prior p, training minimises the non-negative unbiased risk

    p * L(positives, 1) + max(0, L(unlabelled, 0) - p * L(positives, 0))

of a linear model with the logistic loss (Kiryo et al., 2017).

1. One pass over the texts writes their inputs as a table: shares and sizes of the text
   (:func:`quality_rules.measure`), and hashed counts of its words, word pairs and byte triples,
   a byte each.  Labels, lang, source and doc_id are never inputs.
2. Means, scales and every gradient over the unlabelled rows are sums over the whole table; the driver holds the
   weights, the sums and at most ``most`` positives (chosen by hashes of id and
   text), and takes L-BFGS steps.
3. The prior is estimated without negatives: a model that tells positives from unlabelled rows is
   fitted on half of the positives, and of all thresholds the least ratio of unlabelled to other positive
   rows above it, with a margin for chance, bounds the prior (best-bin estimate; Garg et al., 2021).

Null and empty texts have all inputs 0 and get a score like any other.  Repeated rows are
scored row by row, and count as often as they occur in the sums; a doc_id with labels 0 and 1 is no positive.
Without positives or without documents outside the fold every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from framewright.llm import words as W
from framewright.llm.quality_rules import measure
from framewright.storage import materialize, table

MOST_ROWS = 10_000
THRESHOLD = 0.3
FOLDS = 5
#: Steps of the model behind the prior, and from there on of the score's.
PRIOR_STEPS, STEPS = 14, 16
SHARES, WORD_BINS, BYTE_BINS = 10, 256, 128
INPUTS = SHARES + WORD_BINS + BYTE_BINS
#: Weight of the squared weights of shares and of hashed counts.
RIDGE = np.repeat([1e-4, 10.0, 0.0], [SHARES, WORD_BINS + BYTE_BINS, 1])
#: The driver adds up one row of sums (3 KB) for each of so many tasks; of more, as many as gather them.
MOST_TASKS, GATHERERS = 4096, 64
MEMORY = 8
#: Rows of a matrix and bytes of text worked on at once.
MATRIX_ROWS, TEXT_BYTES = 2000, 1 << 18
SCORE_BINS = 1000


def shares(m: dict[str, np.ndarray]) -> np.ndarray:
    """One row of shares and sizes for each text."""
    m = {k: v.astype(np.float64) for k, v in m.items()}
    words, letters, lines = (np.maximum(m[k], 1) for k in ("n_words", "n_letters", "n_lines"))
    each = [m["n_symbols"] / words, m["n_marks"] / words, m["n_stutter"] / words, m["n_repeat_words"] / words, m["n_dup_lines"] / lines, m["n_upper"] / letters, 1 - m["n_alpha_words"] / words, m["n_letters"] / np.maximum(m["word_chars"], 1)]
    return np.stack([*(np.log1p(20 * s) for s in each), np.log1p(m["n_words"]), np.log1p(m["word_chars"] / words)], axis=1)


def _hashed_counts(owner: np.ndarray, hashes: np.ndarray, n: int, bins: int) -> np.ndarray:
    """Roots of each bin's share of a text's hashes, as bytes."""
    at = owner * bins + (hashes >> np.uint64(65 - bins.bit_length())).astype(np.int64)
    count = np.bincount(at, minlength=n * bins).reshape(n, bins)
    return np.round(255 * np.sqrt(count / np.maximum(count.sum(axis=1, keepdims=True), 1))).astype(np.uint8)


def inputs(texts: list[bytes]) -> list[bytes]:
    """The inputs of each text: ``SHARES`` 32-bit numbers and a byte for each bin."""
    buf, at = W.text_bytes(texts)
    found = W.word_digests(buf)
    starts, words = found[0], found[2][:, 0]
    n, owner = len(texts), np.searchsorted(at, found[0], side="right") - 1
    pair = owner[1:] == owner[:-1]
    both = np.concatenate([W.mix(words), W.mix(words[1:] * W.WORD_BASE + words[:-1])[pair]])
    of_words = _hashed_counts(np.concatenate([owner, owner[1:][pair]]), both, n, WORD_BINS)
    low = np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint64)
    triple = W.mix(low[:-2] << np.uint64(16) | low[1:-1] << np.uint64(8) | low[2:]) if len(low) > 2 else np.zeros(0, np.uint64)
    byte_owner = np.repeat(np.arange(n), np.diff(at))[: len(triple)]
    inside = np.arange(len(triple)) + 2 < at[1:][byte_owner] - 1
    of_bytes = _hashed_counts(byte_owner[inside], triple[inside], n, BYTE_BINS)
    dense = shares(measure(texts, found)).astype("<f4") if len(starts) else np.zeros((n, SHARES), "<f4")
    return [a.tobytes() + b.tobytes() + c.tobytes() for a, b, c in zip(dense, of_words, of_bytes, strict=True)]


def matrix(rows: pa.Array | list[bytes]) -> np.ndarray:
    """Rows of inputs as numbers."""
    if isinstance(rows, list):
        rows = pa.array(rows, pa.binary())
    size = 4 * SHARES + WORD_BINS + BYTE_BINS
    flat = np.frombuffer(rows.buffers()[2] or b"", np.uint8)
    at = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset]
    flat = flat[at : at + size * len(rows)].reshape(len(rows), size)
    out = np.empty((len(rows), INPUTS), np.float32)
    out[:, :SHARES] = np.ascontiguousarray(flat[:, : 4 * SHARES]).view("<f4")
    out[:, SHARES:] = flat[:, 4 * SHARES :]
    return out


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == 0


def with_inputs(docs: DataFrame, h: str = "h", x: str = "x", whole: bool = False) -> DataFrame:
    """doc_id (with ``whole`` all columns), a hash of id and text in the column ``h``, and the inputs in ``x``."""
    kept = docs.columns if whole else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.blocks(batch, "text", TEXT_BYTES):
                found = inputs([(t or "").encode() for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), part.column(h), pa.array(found, pa.binary())], [*kept, h, x])

    read = docs if whole else docs.select("doc_id", "text")
    schema = StructType([*(docs.schema[c] for c in kept), StructField(h, LongType()), StructField(x, BinaryType())])
    return read.withColumn(h, F.xxhash64("doc_id", "text")).mapInArrow(run, schema)


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of the sum of rows of sums, if there are any."""
    total = None
    for batch in batches:
        for row in batch.column("sums"):
            one = np.frombuffer(row.as_py())
            total = one.copy() if total is None else total + one
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def _summed(rows: DataFrame, part, many: bool = False) -> np.ndarray:
    """The sum over all rows' inputs of what ``part`` gives for a batch of them (an array of fixed length).  With
    ``many`` tasks their sums meet in a few before they reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for k in range(0, batch.num_rows, MATRIX_ROWS):
                one = part(matrix(batch.column("x").slice(k, MATRIX_ROWS))).astype(np.float64)
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    sums = rows.select("x").mapInArrow(run, "sums binary")
    if many:
        sums = sums.repartition(GATHERERS).mapInArrow(gather, "sums binary")
    found = sums.collect()
    return sum((np.frombuffer(r["sums"]) for r in found), np.zeros(1)) if found else np.zeros(0)


@dataclass
class Scale:
    """Brings inputs to mean 0 and deviation 1.  Batches stay as they are: weights of scaled inputs, with that of the
    constant 1 at the end, become weights of plain ones, and gradients the other way."""

    mean: np.ndarray
    deviation: np.ndarray

    def plain(self, w: np.ndarray) -> tuple[np.ndarray, float]:
        v = w[:-1] / self.deviation
        return v.astype(np.float32), float(w[-1] - v @ self.mean)

    def logits(self, x: np.ndarray, w: np.ndarray) -> np.ndarray:
        v, b = self.plain(w)
        return (x @ v).astype(np.float64) + b

    def scaled(self, sums: np.ndarray) -> np.ndarray:
        """Value and gradient by the scaled weights, of value, gradient by the plain ones and by their constant."""
        grad, b = sums[1:-1], sums[-1]
        return np.concatenate([sums[:1], (grad - b * self.mean) / self.deviation, [b]])


def scale_of(rows: DataFrame, many: bool = False) -> tuple[Scale, int] | None:
    """The scale of all rows, and their number."""
    sums = _summed(rows, lambda x: np.concatenate([[len(x)], x.sum(axis=0, dtype=np.float64), np.einsum("ij,ij->j", x, x, dtype=np.float64)]), many)
    if not len(sums):
        return None
    n, first, second = sums[0], sums[1 : 1 + INPUTS], sums[1 + INPUTS :]
    mean = first / n
    return Scale(mean, np.sqrt(np.maximum(second / n - mean**2, 0)) + np.repeat([0.01, 2.5], [SHARES, WORD_BINS + BYTE_BINS])), int(n)


def _loss(z: np.ndarray, sign: int, x: np.ndarray) -> np.ndarray:
    """Summed logistic loss of rows as if all had the label of that sign, and its gradient by weights and constant."""
    slope = -sign / (1 + np.exp(np.clip(sign * z, -500, 500)))
    return np.concatenate([[np.logaddexp(0, -sign * z).sum()], slope.astype(x.dtype) @ x, [slope.sum()]])


def minimise(objective, w: np.ndarray, steps: int) -> np.ndarray:
    """Weights after so many L-BFGS steps with halved step lengths; ``objective`` gives value and gradient."""
    value, grad = objective(w)
    history: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, alphas = grad.copy(), []
        for s, y in reversed(history):
            alphas.append((s @ d) / (s @ y))
            d -= alphas[-1] * y
        if history:
            s, y = history[-1]
            d *= (s @ y) / (y @ y)
        else:
            d /= max(np.linalg.norm(d), 1e-12)
        for (s, y), a in zip(history, reversed(alphas), strict=True):
            d += (a - (y @ d) / (s @ y)) * s
        length, slope = 1.0, -(grad @ d)
        for _ in range(8):
            new_value, new_grad = objective(w - length * d)
            if new_value <= value + 1e-4 * length * slope:
                break
            length /= 2
        else:
            break
        s, y = -length * d, new_grad - grad
        if s @ y > 1e-12:
            history = [*history, (s, y)][-MEMORY:]
        done = value - new_value < 1e-6 * max(abs(value), 1e-6)
        w, value, grad = w + s, new_value, new_grad
        if done:
            break
    return w


def _unlabelled_loss(rows: DataFrame, scale: Scale, w: np.ndarray, n: int, many: bool) -> np.ndarray:
    """Mean loss of all rows as negatives, and its gradient."""
    return scale.scaled(_summed(rows, lambda x: _loss(scale.logits(x, w), -1, x), many)) / n


def pu_risk(positive: np.ndarray, scale: Scale, unlabelled, prior: float):
    """The non-negative risk of weights, and its gradient; ``unlabelled`` gives its loss as negatives."""

    def risk(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = scale.logits(positive, w)
        as_one, as_zero = (scale.scaled(_loss(z, sign, positive)) / len(positive) for sign in (1, -1))
        rest = unlabelled(w) - prior * as_zero
        total = prior * as_one + (rest if rest[0] > 0 else 0)
        return total[0] + (RIDGE * w * w).sum() / 2, total[1:] + RIDGE * w

    return risk


def told_apart(positive: np.ndarray, scale: Scale, unlabelled):
    """The mean loss of telling positives from unlabelled rows, both with weight a half."""

    def risk(w: np.ndarray) -> tuple[float, np.ndarray]:
        total = (scale.scaled(_loss(scale.logits(positive, w), 1, positive)) / len(positive) + unlabelled(w)) / 2
        return total[0] + (RIDGE * w * w).sum() / 2, total[1:] + RIDGE * w

    return risk


def best_bin(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The estimate of the prior from counts of scores in bins, of positives and of unlabelled rows."""
    p, u = (np.cumsum(c[::-1]) for c in (positive, unlabelled))
    enough = p > 0
    margin = np.sqrt(np.log(4 / 0.1) / 2) * (1 / np.sqrt(p[-1]) + 1 / np.sqrt(u[-1]))
    q_p, q_u = p[enough] / p[-1], u[enough] / u[-1]
    k = np.argmin((q_u + margin) / q_p)
    return float(np.clip(q_u[k] / q_p[k], 0.01, 0.99))


@dataclass
class Model:
    scale: Scale
    weights: np.ndarray
    prior: float

    def score(self, rows: pa.Array | list[bytes]) -> np.ndarray:
        return _sigmoid(self.scale.logits(matrix(rows), self.weights)) if len(rows) else np.zeros(0)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(-z, -500, 500)))


def fit(rows: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> Model | None:
    """The model from rows with inputs (:func:`with_inputs`), or None if there is nothing to learn from."""
    known = labels.where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1")
    unlabelled = rows.where(~held_out())
    many = unlabelled.rdd.getNumPartitions() > MOST_TASKS
    found = scale_of(unlabelled, many)
    trusted = unlabelled.join(known.select("doc_id"), "doc_id", "left_semi")
    n_trusted = trusted.count()
    if found is None or not n_trusted:
        return None
    # by hash, a few more than wanted, so that no task sends the driver as many
    low = F.pmod(F.xxhash64("h"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, 1.2 * most / n_trusted))
    chosen = trusted.where(low).groupBy("h").agg(F.first("x").alias("x")).orderBy("h").limit(most).select("x").toPandas()
    scale, n = found
    positive = matrix(chosen["x"].tolist())
    if not len(positive):
        return None
    loss = lambda w: _unlabelled_loss(unlabelled, scale, w, n, many)
    half = positive[::2], positive[1::2] if len(positive) > 1 else positive
    apart = minimise(told_apart(half[0], scale, loss), np.zeros(INPUTS + 1), PRIOR_STEPS)
    binned = lambda x: np.bincount(np.minimum((_sigmoid(scale.logits(x, apart)) * SCORE_BINS).astype(np.int64), SCORE_BINS - 1), minlength=SCORE_BINS)
    prior = best_bin(binned(half[1]), _summed(unlabelled, binned, many))
    return Model(scale, minimise(pu_risk(positive, scale, loss, prior), apart, STEPS), prior)


def score(docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """The documents with a score from 0 to 1 in the column ``name``, which replaces one of that name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.blocks(batch, "text", TEXT_BYTES):
                found = np.full(part.num_rows, 0.5) if model is None else model.score(inputs([(t or "").encode() for t in part.column("text").to_pylist()]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found.astype(np.float64))], [*part.schema.names, name])

    plain = docs.drop(name)
    return plain.mapInArrow(run, StructType([*plain.schema.fields, StructField(name, DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the threshold, all their columns as they were.  They are written once
    with their inputs, which are worked out once."""
    free = "_" + max(docs.columns, key=len)  # longer than any of theirs
    h, x = f"{free}h", f"{free}x"
    wide = materialize(with_inputs(docs, h, x, whole=True), "inputs")
    columns, model = docs.columns, fit(wide.select("doc_id", F.col(f"`{h}`").alias("h"), F.col(f"`{x}`").alias("x")), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, MATRIX_ROWS):
                part = batch.slice(k, MATRIX_ROWS)
                good = np.full(part.num_rows, 0.5) if model is None else model.score(part.column(x))
                yield part.filter(pa.array(good >= THRESHOLD)).select(columns)

    return wide.drop(h).mapInArrow(run, docs.schema)


def score_rows(rows: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and ``score`` of rows with inputs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.full(batch.num_rows, 0.5) if model is None else model.score(batch.column("x"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.astype(np.float64))], ["doc_id", "score"])

    return rows.select("doc_id", "x").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(with_inputs(table(spark, sf_dir, "documents")), "inputs")
    scored = score_rows(rows, fit(rows, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
