"""Quality classifier: a factorisation machine.

Features of a text are its hashed words, structure statistics and its size. All
pairs of features interact through vectors of low rank; the sum over all pairs
of <v_i, v_j> x_i x_j is half of (sum v_i x_i)^2 - sum (v_i x_i)^2 per
dimension, so a text is scored in time linear in its words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contestlab.llm.registry import registered
from contestlab.llm.samples import Sample, held_out, labelled_sample
from contestlab.llm.tables import (
    bounded_batches,
    extended,
    fresh,
    quoted,
    read,
    slices,
    text_slices,
    with_fields,
)
from contestlab.llm.words import (
    _BASE,
    _INVERSE,
    CHUNK_BYTES,
    batch_words,
    mix,
    power,
    running_sums,
    spans,
    text_bytes,
)

BUCKETS = 1 << 16
RANK = 8
EPOCHS = 6
LEAST_STEPS = 250  # a small sample takes more epochs
BATCH = 128
THRESHOLD = 0.3
SEED = 5


def _byte_classes() -> np.ndarray:
    """One column per kind of byte: upper case, digit, other printable ASCII
    sign, white space, line end, part of a non-ASCII character."""
    b = np.arange(256)
    upper = (b >= 65) & (b <= 90)
    digit = (b >= 48) & (b <= 57)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    letter = upper | ((b >= 97) & (b <= 122))
    sign = (b > 32) & (b < 127) & ~digit & ~letter
    return np.stack([upper, digit, sign, space, b == 10, b >= 128], axis=1)


_CLASSES = _byte_classes()
STATISTICS = _CLASSES.shape[1] + 8


def _distinct(owner: np.ndarray, values: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the count of the most frequent value, by text."""
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
    starts = np.flatnonzero(new)
    runs = np.diff(np.append(starts, len(o)))
    most = np.zeros(texts)
    np.maximum.at(most, o[starts], runs)
    return np.bincount(o[starts], minlength=texts), most


@dataclass(frozen=True)
class Features:
    """Distinct hashed words as (text, bucket) pairs with their value, and the
    structure statistics of each text."""

    owner: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    statistics: np.ndarray


def class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each kind every text has, some bytes at a time."""
    out = np.zeros((len(offsets) - 1, _CLASSES.shape[1]), np.int64)
    for at in range(0, len(data), CHUNK_BYTES):
        part = data[at : at + CHUNK_BYTES]
        own = np.clip(offsets - at, 0, len(part))
        for k in range(_CLASSES.shape[1]):
            run = np.concatenate([[0], np.cumsum(_CLASSES[part, k])])
            out[:, k] += run[own[1:]] - run[own[:-1]]
    return out


def line_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of all lines, some bytes at a time; a line may go on
    through any number of chunks."""
    starts, ends = spans(data != 10, offsets)
    sums = np.zeros(len(starts), np.uint64)
    for at in range(0, len(data), CHUNK_BYTES):
        part = data[at : at + CHUNK_BYTES]
        own = slice(np.searchsorted(ends, at, "right"), np.searchsorted(starts, at + len(part)))
        run = running_sums(part) * power(_BASE, np.array([at]))
        first, last = (np.clip(x[own] - at, 0, len(part)) for x in (starts, ends))
        sums[own] += run[last] - run[first]
    return starts, mix(sums * power(_INVERSE, starts))


def features(texts: pa.Array) -> Features:
    n = len(texts)
    data, offsets = text_bytes(texts)
    words = batch_words(texts)
    owner = words.owners()
    counts = np.diff(words.offsets).astype(np.float64)
    per_text = np.maximum(np.diff(offsets), 1).astype(np.float64)
    statistics = np.zeros((n, STATISTICS), np.float32)
    statistics[:, : _CLASSES.shape[1]] = class_counts(data, offsets) / per_text[:, None]
    distinct, most = _distinct(owner, words.hashes, n)
    starts, hashes = line_hashes(data, offsets)
    line_owner = np.searchsorted(offsets, starts, "right") - 1
    lines = np.bincount(line_owner, minlength=n).astype(np.float64)
    line_kinds, line_most = _distinct(line_owner, hashes, n)
    some, some_lines = np.maximum(counts, 1), np.maximum(lines, 1)
    length = np.bincount(owner, words.lengths, n) / some
    rest = [
        distinct / some,
        most / some,
        length / 10,
        line_kinds / some_lines,
        line_most / some_lines,
        np.log1p(counts) / 5,
        np.log1p(np.diff(offsets)) / 5,
        np.log1p(lines) / 3,
    ]
    statistics[:, _CLASSES.shape[1] :] = np.stack(rest, axis=1)

    key = np.unique((owner.astype(np.int64) << 16) | (words.hashes % BUCKETS).astype(np.int64))
    pair_owner, bucket = key >> 16, (key & 0xFFFF).astype(np.int32)
    pairs = np.maximum(np.bincount(pair_owner, minlength=n), 1)
    return Features(pair_owner, bucket, (1 / np.sqrt(pairs))[pair_owner].astype(np.float32), statistics)


def features_by_slices(texts: pa.Array) -> Features:
    """``features`` of many texts, some at a time: the arrays it works on take
    many times the bytes of the texts."""
    parts, at = [], 0
    for piece in text_slices(texts):
        f = features(piece)
        parts.append((f.owner + at, f.bucket, f.value, f.statistics))
        at += len(piece)
    return Features(*map(np.concatenate, zip(*parts)))


@dataclass(frozen=True)
class Machine:
    """Weights and factors; the last ``STATISTICS`` rows are those of the
    structure statistics, which are centred and scaled first."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        f = features(texts)
        n = len(texts)
        x = np.clip((f.statistics - self.centre) / self.scale, -4, 4)
        linear = np.bincount(f.owner, self.weights[f.bucket] * f.value, n) + x @ self.weights[BUCKETS:]
        pairs = np.zeros(n)
        for k in range(self.factors.shape[1]):
            part = self.factors[f.bucket, k] * f.value
            fixed = x * self.factors[BUCKETS:, k]
            total = np.bincount(f.owner, part, n) + fixed.sum(axis=1)
            pairs += total**2 - np.bincount(f.owner, part**2, n) - (fixed**2).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pairs / 2, -30, 30)))


def _adam(state: dict, name: str, value: np.ndarray, gradient: np.ndarray, rate: float, t: int):
    m, s = state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
    m += 0.1 * (gradient - m)
    s += 0.001 * (gradient**2 - s)
    value -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)


def fit(sample: Sample, epochs: int = EPOCHS, rate: float = 0.02, penalty: float = 1e-4) -> Machine:
    """Logistic loss, by Adam over batches in a seeded order. Without both
    labels in the sample the machine answers their share everywhere."""
    rng = np.random.default_rng(SEED)
    n, y = len(sample.labels), sample.labels
    size = BUCKETS + STATISTICS
    w = np.zeros(size, np.float32)
    v = rng.normal(0, 0.02, (size, RANK)).astype(np.float32)
    share = float((y.sum() + 0.5) / (n + 1))
    bias = np.array([np.log(share / (1 - share))])
    if n == 0 or y.min() == y.max():
        v[:] = 0
        return Machine(float(bias[0]), w, v, np.zeros(STATISTICS), np.ones(STATISTICS))
    f = features_by_slices(sample.texts)
    centre, scale = f.statistics.mean(axis=0), f.statistics.std(axis=0) + 1e-3
    x = np.clip((f.statistics - centre) / scale, -4, 4)
    offsets = np.searchsorted(f.owner, np.arange(n + 1))
    state: dict = {}
    t = 0
    for _ in range(max(epochs, -(-LEAST_STEPS * BATCH // n))):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            t += 1
            rows = order[at : at + BATCH]
            b = len(rows)
            counts = offsets[rows + 1] - offsets[rows]
            owner = np.concatenate([np.repeat(np.arange(b), counts), np.repeat(np.arange(b), STATISTICS)])
            pick = np.concatenate([np.arange(offsets[r], offsets[r + 1]) for r in rows])
            index = np.concatenate([f.bucket[pick], np.tile(np.arange(BUCKETS, size), b)])
            value = np.concatenate([f.value[pick], x[rows].ravel()])
            part = v[index] * value[:, None]
            total = np.stack([np.bincount(owner, part[:, k], b) for k in range(RANK)], axis=1)
            squares = np.bincount(owner, (part**2).sum(axis=1), b)
            z = bias[0] + np.bincount(owner, w[index] * value, b) + ((total**2).sum(axis=1) - squares) / 2
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / b
            pull = error[owner] * value
            gw = np.bincount(index, pull, size) + penalty * w
            inner = pull[:, None] * (total[owner] - part)
            gv = np.stack([np.bincount(index, inner[:, k], size) for k in range(RANK)], axis=1)
            _adam(state, "w", w, gw.astype(np.float32), rate, t)
            _adam(state, "v", v, (gv + penalty * v).astype(np.float32), rate / 4, t)
            _adam(state, "b", bias, np.array([error.sum()]), rate, t)
    return Machine(float(bias[0]), w, v, centre, scale)


def quality_scores(
    df: DataFrame, labels: DataFrame, text: str = "text", name: str = "score"
) -> DataFrame:
    """Add the quality score (under a fresh name if taken) to every row.

    Null and empty texts are scored by their statistics alone. Repeated rows are
    scored each. The machine has a fixed size and is broadcast.
    """
    name = fresh(df.columns, name)[0]
    parameters = df.sparkSession.sparkContext.broadcast(
        vars(fit(labelled_sample(df, labels, "quality")))
    )

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(**parameters.value)
        for piece in slices(batches, text):
            found = machine.scores(piece.column(text))
            yield extended(piece, **{name: pa.array(found, pa.float64())})

    return bounded_batches(df).mapInArrow(score, with_fields(df, f"`{name}` double"))


@registered("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_scores(docs, read(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (quoted("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
