"""Toxicity: a convolutional text classifier, fitted with numpy.

A word's embedding is the sum of those of its hash and of the hashes of its
first bytes, so that inflected forms share one; filters of several widths slide over all words of
a text, each filter keeps its largest answer, and a linear layer joins those.
Hashes too rare in the labelled texts share the zero vector. The threshold is set
per language, which is guessed from the text's function words, and the score is
shifted so that every language's threshold is at one half.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contestlab.llm.registry import registered
from contestlab.llm.samples import Labelled, Sample, all_labelled, held_out, labelled_sample
from contestlab.llm.tables import (
    bounded_batches,
    extended,
    fresh,
    give_back,
    quoted,
    read,
    slices,
    text_slices,
    with_fields,
)
from contestlab.llm.words import Words, batch_words

BUCKETS = 1 << 20
WIDTHS = (1, 2, 3)
FILTERS = 8
DIMENSIONS = 8
PREFIXES = (4, 6)
MIN_TEXTS = 3
EPOCHS = 6
LEAST_STEPS = 500  # a small sample takes more epochs
BATCH = 64
PART_WORDS = 1 << 17
THRESHOLD = 0.5
SEED = 4
CALIBRATION = 5  # one fitted row in so many sets thresholds
LEAST_POSITIVES = 5

# Frequent function words by language.
FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was"],
    "fr": ["le", "les", "des", "et", "que", "qui", "du", "une", "dans", "est"],
    "de": ["der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "ein"],
    "es": ["el", "los", "las", "que", "y", "del", "una", "con", "por", "para"],
}


def languages(words: Words) -> np.ndarray:
    """The place in FUNCTION_WORDS of the language with most function words;
    one more than the last for texts with none."""
    n = len(words.offsets) - 1
    owner = words.owners()
    counts = []
    for listed in FUNCTION_WORDS.values():
        hashes = batch_words(pa.array([" ".join(listed)])).hashes
        counts.append(np.bincount(owner[np.isin(words.hashes, hashes)], minlength=n))
    counts = np.stack(counts)
    return np.where(counts.max(axis=0) > 0, counts.argmax(axis=0), len(FUNCTION_WORDS))


def buckets(words: Words) -> np.ndarray:
    """A row of buckets per word: of the whole and of its prefixes; -1 for a
    prefix that the word is too short for."""
    columns = [(words.hashes % BUCKETS).astype(np.int32)]
    for head in words.prefixes:
        columns.append(np.where(head > 0, head % BUCKETS, -1).astype(np.int32))
    return np.stack(columns, axis=1)


@dataclass
class Network:
    """``rows`` maps a bucket to its embedding, 0 (the zero vector) if it has
    none, as has the last entry, for bucket -1. ``thresholds`` are by language, in units of the raw answer."""

    rows: np.ndarray
    embeddings: np.ndarray
    kernels: list[np.ndarray]  # one (width, dimensions, filters) per width
    shifts: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray
    thresholds: np.ndarray

    def laid_out(self, tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedding rows of all texts with zero vectors behind each, and where
        the texts start. A text without words is one zero vector."""
        tail = max(WIDTHS) - 1
        counts = np.diff(offsets)
        spaces = np.maximum(counts, 1) + tail
        starts = np.concatenate([[0], np.cumsum(spaces)])
        index = np.zeros((starts[-1], 1 + len(PREFIXES)), np.int64)
        place = np.arange(len(tokens)) + np.repeat(starts[:-1] - offsets[:-1], counts)
        index[place] = tokens
        return index, starts

    def convolved(self, vectors: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
        """Answers of the filters of one width at each start of a window; minus
        infinity where only the space behind a text is left."""
        width, tail = WIDTHS[k], max(WIDTHS) - 1
        n = len(vectors)
        out = np.full((n, FILTERS), -np.inf, np.float32)
        total = vectors[: n - width + 1] @ self.kernels[k][0]
        for o in range(1, width):
            total += vectors[o : n - width + 1 + o] @ self.kernels[k][o]
        out[: n - width + 1] = total + self.shifts[k]
        for back in range(1, tail + 1):
            out[starts[1:] - back] = -np.inf
        return out

    def answers(self, tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The raw answer, before thresholds, for each text of embedding rows. Long
        texts are gone through in parts of ``PART_WORDS`` windows, and some parts
        at a time; a filter's largest answer is that of all parts."""
        tail, counts = max(WIDTHS) - 1, np.diff(offsets)
        several = np.maximum(-(-counts // PART_WORDS), 1)
        owner = np.repeat(np.arange(len(counts)), several)
        part = np.arange(len(owner)) - np.repeat(np.cumsum(several) - several, several)
        begin = offsets[owner] + part * PART_WORDS
        last = part == several[owner] - 1
        end = np.where(last, offsets[owner + 1], np.minimum(begin + PART_WORDS + tail, offsets[owner + 1]))
        pooled = np.full((len(counts), FILTERS * len(WIDTHS)), -np.inf, np.float32)
        at = 0
        while at < len(owner):
            held = np.cumsum(end[at:] - begin[at:])
            stop = at + max(1, int(np.searchsorted(held, PART_WORDS, "right")))
            own = np.concatenate([np.arange(a, b) for a, b in zip(begin[at:stop], end[at:stop])])
            bounds = np.concatenate([[0], np.cumsum(end[at:stop] - begin[at:stop])])
            # Words of the next part, fewer than the tail at the very end.
            shared = np.where(last[at:stop], 0, end[at:stop] - begin[at:stop] - PART_WORDS)
            np.maximum.at(pooled, owner[at:stop], self.pooled(tokens[own], bounds, shared))
            at = stop
        return np.maximum(pooled, 0) @ self.output + self.bias[0]

    def pooled(self, tokens: np.ndarray, bounds: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """The largest answer of every filter in each part of embedding rows, from
        windows that do not start in the last ``shared`` words."""
        index, starts = self.laid_out(tokens, bounds)
        vectors = sum(self.embeddings[column] for column in index.T)
        out = []
        for k in range(len(WIDTHS)):
            found = self.convolved(vectors, starts, k)
            for back in range(1, max(WIDTHS)):
                own = shared >= back
                found[starts[1:][own] - (max(WIDTHS) - 1) - back] = -np.inf
            out.append(np.maximum.reduceat(found, starts[:-1], axis=0))
        return np.concatenate(out, axis=1)

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        words = batch_words(texts, PREFIXES)
        answers = self.answers(self.rows[buckets(words)], words.offsets)
        shifted = answers - self.thresholds[languages(words)]
        return 1 / (1 + np.exp(-np.clip(shifted.astype(np.float64), -30, 30)))


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.state = rate, 0, {}

    def step(self, values: list[np.ndarray], gradients: list[np.ndarray]) -> None:
        self.t += 1
        for i, (value, gradient) in enumerate(zip(values, gradients)):
            m, s = self.state.setdefault(i, (np.zeros_like(value), np.zeros_like(value)))
            m += 0.1 * (gradient - m)
            s += 0.001 * (gradient**2 - s)
            seen = np.sqrt(s / (1 - 0.999**self.t)) + 1e-8
            value -= self.rate * (m / (1 - 0.9**self.t)) / seen


def _batches(order: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """Up to ``BATCH`` rows, and up to ``PART_WORDS`` words but for a single row."""
    for at in range(0, len(order), BATCH):
        rows = order[at : at + BATCH]
        while len(rows):
            held = np.cumsum(counts[rows])
            stop = max(1, int(np.searchsorted(held, PART_WORDS, "right")))
            yield rows[:stop]
            rows = rows[stop:]


def _largest(
    net: Network, tokens: np.ndarray, bounds: np.ndarray, shared: int = 0
) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """The largest answer of every filter in each text, and by width and place in
    the window the embedding rows that it comes from (texts, filters, columns).
    Windows that start in the last ``shared`` words do not count."""
    index, starts = net.laid_out(tokens, bounds)
    vectors = net.embeddings[index].sum(axis=1)
    raw, picked = [], []
    for k, width in enumerate(WIDTHS):
        conv = net.convolved(vectors, starts, k)
        for back in range(1, shared + 1):
            conv[starts[1:] - (max(WIDTHS) - 1) - back] = -np.inf
        place = np.stack([a + conv[a:b].argmax(axis=0) for a, b in zip(starts[:-1], starts[1:])])
        raw.append(np.take_along_axis(conv, place, axis=0))
        picked.append([index[place + o] for o in range(width)])
    return np.concatenate(raw, axis=1), picked


def _largest_by_parts(
    net: Network, tokens: np.ndarray
) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """``_largest`` of one text, ``PART_WORDS`` windows at a time."""
    tail, n = max(WIDTHS) - 1, len(tokens)
    best = None
    for begin in range(0, n, PART_WORDS):
        end = min(begin + PART_WORDS + tail, n)
        last = begin + PART_WORDS >= n
        part = tokens[begin:end]
        shared = 0 if last else len(part) - PART_WORDS
        raw, picked = _largest(net, part, np.array([0, len(part)]), shared)
        if best is None:
            best = raw, picked
            continue
        better = raw > best[0]
        best[0][better] = raw[better]
        for k in range(len(WIDTHS)):
            own = better[:, k * FILTERS : (k + 1) * FILTERS]
            for before, now in zip(best[1][k], picked[k]):
                before[own] = now[own]
    return best


def _train(
    net: Network,
    tokens: np.ndarray,
    offsets: np.ndarray,
    y: np.ndarray,
    rows: np.ndarray,
    positive: float,
    epochs: int,
) -> None:
    """``positive`` is the weight of a row with label 1."""
    rng = np.random.default_rng(SEED)
    weight = np.where(y > 0, positive, 1.0)
    counts = np.diff(offsets)
    adam = _Adam(0.01)
    for _ in range(epochs):
        for batch in _batches(rng.permutation(rows), counts):
            own = np.concatenate([np.arange(offsets[r], offsets[r + 1]) for r in batch])
            bounds = np.concatenate([[0], np.cumsum(counts[batch])])
            if len(own) > PART_WORDS:
                raw, picked = _largest_by_parts(net, tokens[own])
            else:
                raw, picked = _largest(net, tokens[own], bounds)
            hidden = np.maximum(raw, 0)
            z = hidden @ net.output + net.bias[0]
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]) * weight[batch]
            error = (error / len(batch)).astype(np.float32)
            back = error[:, None] * net.output[None, :] * (raw > 0)
            d_embeddings = np.zeros_like(net.embeddings)
            d_kernels, d_shifts = [], []
            for k, width in enumerate(WIDTHS):
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                d_kernel = np.zeros_like(net.kernels[k])
                for o in range(width):
                    at_o = picked[k][o]
                    vectors = net.embeddings[at_o].sum(axis=-2)
                    d_kernel[o] = np.einsum("bf,bfd->df", part, vectors)
                    push = part[:, :, None] * net.kernels[k][o].T[None]
                    for column in np.moveaxis(at_o, -1, 0):
                        np.add.at(d_embeddings, column, push)
                d_kernels.append(d_kernel)
                d_shifts.append(part.sum(axis=0))
            d_embeddings[0] = 0
            adam.step(
                [net.embeddings, *net.kernels, *net.shifts, net.output, net.bias],
                [
                    d_embeddings + 1e-5 * net.embeddings,
                    *d_kernels,
                    *d_shifts,
                    hidden.T @ error + 1e-4 * net.output,
                    np.array([error.sum()], np.float32),
                ],
            )
            net.embeddings[0] = 0


def positive_weight(rows: int, positives: float) -> float:
    return min(5.0, (rows - positives) / positives)


def threshold(answers: np.ndarray, y: np.ndarray) -> float:
    """The cut with fewest errors; midway where several cuts are equal."""
    order = np.argsort(answers, kind="stable")
    a, positive = answers[order], y[order] > 0
    errors = np.concatenate([[0], np.cumsum(positive)]) + (~positive).sum()
    errors = errors - np.concatenate([[0], np.cumsum(~positive)])
    best = np.flatnonzero(errors == errors.min())
    cuts = np.concatenate([[a[0] - 1], (a[1:] + a[:-1]) / 2, [a[-1] + 1]])
    return float(cuts[best].mean())


def tokenized(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words, the texts' languages and where each text starts, and
    how many texts have each bucket. Some texts are taken at a time: the arrays
    it works on take many times their bytes."""
    found = [np.zeros((0, 1 + len(PREFIXES)), np.int32)]
    language, counts = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
    having = np.zeros(BUCKETS, np.int64)
    for piece in text_slices(texts):
        words = batch_words(piece, PREFIXES)
        own = buckets(words)
        owners = np.repeat(words.owners(), own.shape[1])[own.ravel() >= 0]
        pairs = np.unique(owners * BUCKETS + own[own >= 0])
        having += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
        found.append(own)
        language.append(languages(words))
        counts.append(np.diff(words.offsets))
    offsets = np.cumsum(np.concatenate(counts))
    return np.concatenate(found), np.concatenate(language), offsets, having


def fit(sample: Sample) -> Network:
    """Fit on the sample. Without both labels in it, the network answers no
    threshold but the labels' share everywhere."""
    rng = np.random.default_rng(SEED)
    n, y = len(sample.labels), sample.labels
    found, language, offsets, texts = tokenized(sample.texts)
    kept = np.flatnonzero(texts >= MIN_TEXTS)
    rows = np.zeros(BUCKETS + 1, np.int32)
    rows[kept] = np.arange(1, len(kept) + 1)
    embeddings = rng.normal(0, 0.2, (len(kept) + 1, DIMENSIONS)).astype(np.float32)
    embeddings[0] = 0
    share = float((y.sum() + 0.5) / (n + 1))
    net = Network(
        rows,
        embeddings,
        [rng.normal(0, 0.4, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.2, FILTERS * len(WIDTHS)).astype(np.float32),
        np.array([np.log(share / (1 - share))], np.float32),
        np.zeros(len(FUNCTION_WORDS) + 1, np.float32),
    )
    place = np.arange(n)
    train = place[place % CALIBRATION != 0]
    if n == 0 or y.min() == y.max() or len(set(y[train].tolist())) < 2:
        net.output[:] = 0
        return net
    tokens = rows[found]
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(train)))
    _train(net, tokens, offsets, y, train, positive_weight(len(train), y[train].sum()), epochs)
    answers = np.concatenate(
        [
            net.answers(tokens[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for a, b in zip(range(0, n, BATCH), [*range(BATCH, n, BATCH), n])
        ]
    )
    test = place[place % CALIBRATION == 0]
    if y[test].sum() < LEAST_POSITIVES:
        test = place  # a sample too small to keep rows apart
    overall = threshold(answers[test], y[test])
    for k in range(len(net.thresholds)):
        own = test[language[test] == k]
        enough = y[own].sum() >= LEAST_POSITIVES
        net.thresholds[k] = threshold(answers[own], y[own]) if enough else overall
    return net


# A fit on any number of rows: groups are trained on side by side from the network
# of a sample, which the weighted mean of theirs replaces.
GROUP_ROWS = 6000
GROUP_BYTES = 64 << 20
GROUP_STEPS = 60  # a small group takes more epochs
SCALE = 1 << 14  # of the whole numbers that are summed, in whatever order
BLOCK = 1 << 12  # parameters that are shuffled together
STEPS = 1000  # of an answer's unit, where answers are counted


def _set_aside() -> Column:
    """Labelled rows that are not trained on but set thresholds."""
    return F.pmod(F.xxhash64(F.lit(SEED), quoted("doc_id")), F.lit(CALIBRATION)) == 0


def _first_embeddings() -> np.ndarray:
    rng = np.random.default_rng(SEED + 1)
    return rng.standard_normal((BUCKETS, DIMENSIONS), np.float32) * np.float32(0.2)


def _dense(net: Network) -> list[np.ndarray]:
    return [*net.kernels, *net.shifts, net.output, net.bias]


def _packed(slots: np.ndarray, weights: np.ndarray, values: np.ndarray) -> bytes:
    """Whole numbers by slot, near zero for most: small ones have zeros in their
    upper bytes, which are put side by side and compressed."""
    small = ((values << 1) ^ (values >> 31)).astype("<u4")
    columns = np.concatenate([slots[None], weights[None], small.T]).astype("<u4")
    planes = np.ascontiguousarray(columns).view(np.uint8).reshape(-1, 4).T
    return zlib.compress(planes.tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    columns = np.ascontiguousarray(planes.T).view("<u4").reshape(2 + DIMENSIONS, -1).astype(np.int64)
    return columns[0], columns[1], ((columns[2:] >> 1) ^ -(columns[2:] & 1)).T


def _trained_group(
    net: Network, sample: Sample, aside: np.ndarray, positive: float
) -> pa.RecordBatch:
    """The network after training on one group, packed by block. A slot is a bucket
    of the group or, behind the buckets, ``DIMENSIONS`` of the other parameters."""
    found, _, offsets, texts = tokenized(sample.texts)
    own = np.flatnonzero(texts)
    had = net.rows[own]
    values = np.where((had > 0)[:, None], net.embeddings[had], _first_embeddings()[own])
    rows = np.zeros(BUCKETS + 1, np.int32)
    rows[own] = np.arange(1, len(own) + 1)
    table = np.concatenate([np.zeros((1, DIMENSIONS), np.float32), values])
    copies = [part.copy() for part in _dense(net)]
    k = len(WIDTHS)
    local = Network(rows, table, copies[:k], copies[k : 2 * k], *copies[2 * k :], net.thresholds)
    train = np.flatnonzero(~aside)
    epochs = max(1, -(-GROUP_STEPS * BATCH // max(1, len(train))))
    _train(local, rows[found], offsets, sample.labels, train, positive, epochs)
    flat = np.concatenate([part.ravel() for part in _dense(local)])
    flat = np.pad(flat, (0, -len(flat) % DIMENSIONS)).reshape(-1, DIMENSIONS)
    slots = np.concatenate([own, BUCKETS + np.arange(len(flat))])
    weights = np.concatenate([texts[own], np.full(len(flat), len(train))])
    whole = np.rint(np.concatenate([local.embeddings[1:], flat]).astype(np.float64) * SCALE)
    whole = whole.astype(np.int32)
    blocks, first = np.unique(slots // BLOCK, return_index=True)
    ends = np.append(first[1:], len(slots))
    packed = [_packed(slots[a:b], weights[a:b], whole[a:b]) for a, b in zip(first, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int32()), pa.array(packed, pa.binary())], names=["block", "packed"]
    )


def _added(table: pa.Table) -> pa.Table:
    """The slots of one block and their means over all groups, packed: what reaches the
    driver is a row a block, and four bytes a parameter."""
    start = table.column("block")[0].as_py() * BLOCK
    total, sums = np.zeros(BLOCK, np.int64), np.zeros((BLOCK, DIMENSIONS), np.int64)
    for data in table.column("packed"):
        slots, weights, values = _unpacked(data.as_py())
        total[slots - start] += weights
        sums[slots - start] += weights[:, None] * values
    slots = np.arange(start, start + BLOCK)
    kept = np.where(slots < BUCKETS, total >= MIN_TEXTS, total > 0)
    weights = np.maximum(total[kept], 1) * float(SCALE)
    means = (sums[kept] / weights[:, None]).astype("<f4")
    columns = [[start // BLOCK], [slots[kept].astype("<i4").tobytes()], [means.tobytes()]]
    types = [pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "slots", "means"])


def _mean_of_groups(net: Network, known: Labelled) -> Network:
    """The mean of the networks trained on each group of all labelled rows: of an
    embedding by the texts that have its bucket, of the rest by rows. Buckets of
    fewer than ``MIN_TEXTS`` of all labelled texts have none."""
    spark = known.docs.sparkSession
    groups = max(1, -(-known.rows // GROUP_ROWS), -(-known.bytes // GROUP_BYTES))
    given = spark.sparkContext.broadcast(vars(net))
    positive = positive_weight(known.rows, known.positives)

    def trained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [batch for batch in batches if batch.num_rows]
        if not batches:
            return
        held = pa.Table.from_batches(batches)
        texts = held.column("text").cast(pa.large_string()).combine_chunks()
        sample = Sample(texts, held.column("y").to_numpy().astype(np.float32))
        aside = held.column("aside").to_numpy()
        yield _trained_group(Network(**given.value), sample, aside, positive)
        give_back()

    rows = bounded_batches(known.table(groups)).select("text", "y", _set_aside().alias("aside"))
    parts = rows.mapInArrow(trained, "block int, packed binary").groupBy("block")
    # At most a slot per bucket, whatever the number of rows.
    found = parts.applyInArrow(_added, "block int, slots binary, means binary").toArrow()
    given.destroy()
    found = found.sort_by("block")
    slots = np.concatenate([np.frombuffer(x, "<i4") for x in found.column("slots").to_pylist()])
    means = np.concatenate([np.frombuffer(x, "<f4") for x in found.column("means").to_pylist()])
    means = means.reshape(-1, DIMENSIONS)
    own = slots < BUCKETS
    table = np.zeros(BUCKETS + 1, np.int32)
    table[slots[own]] = np.arange(1, own.sum() + 1)
    embeddings = np.concatenate([np.zeros((1, DIMENSIONS), np.float32), means[own]])
    flat, at, dense = means[~own].ravel(), 0, []
    for part in _dense(net):
        dense.append(flat[at : at + part.size].reshape(part.shape))
        at += part.size
    k = len(WIDTHS)
    return Network(table, embeddings, dense[:k], dense[k : 2 * k], *dense[2 * k :], net.thresholds)


def threshold_of_counts(values: np.ndarray, positives: np.ndarray, negatives: np.ndarray) -> float:
    """``threshold`` of distinct answers in ascending order, with their counts."""
    errors = np.concatenate([[0], np.cumsum(positives)]) + negatives.sum()
    errors = errors - np.concatenate([[0], np.cumsum(negatives)])
    best = np.flatnonzero(errors == errors.min())
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    return float(cuts[best].mean())


def _thresholds(net: Network, known: Labelled, where: Column | None = None) -> np.ndarray | None:
    """Thresholds by language from the answers on all labelled rows, or on those that
    ``where`` keeps; None if too few of these have label 1."""
    spark = known.docs.sparkSession
    given = spark.sparkContext.broadcast(vars(net))

    def answered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(**given.value)
        for piece in slices(batches, "text"):
            words = batch_words(piece.column("text"), PREFIXES)
            answers = own.answers(own.rows[buckets(words)], words.offsets)
            steps = np.rint(np.clip(answers, -30, 30) * STEPS).astype(np.int32)
            columns = [pa.array(languages(words).astype(np.int32)), pa.array(steps), piece.column("y")]
            yield pa.RecordBatch.from_arrays(columns, names=["language", "step", "y"])

    groups = max(1, -(-known.rows // (GROUP_ROWS * CALIBRATION)), -(-known.bytes // GROUP_BYTES))
    rows = bounded_batches(known.table(groups, where)).select("text", "y")
    counts = rows.mapInArrow(answered, "language int, step int, y int").groupBy("language", "step")
    # At most 60 * STEPS + 1 rows a language.
    found = (
        counts.agg(F.count_if(F.col("y") > 0).alias("positives"), F.count_if(F.col("y") <= 0).alias("negatives"))
        .toArrow()
        .sort_by("step")
    )
    given.destroy()
    language, step, positives, negatives = (
        found.column(c).to_numpy() for c in ("language", "step", "positives", "negatives")
    )
    if where is not None and positives.sum() < LEAST_POSITIVES:
        return None

    def best(keep: np.ndarray) -> float:
        values, place = np.unique(step[keep], return_inverse=True)
        both = (np.bincount(place, x[keep]) for x in (positives, negatives))
        return threshold_of_counts(values / STEPS, *both)

    everything = np.ones(len(step), bool)
    out = np.full(len(net.thresholds), best(everything), np.float32)
    for k in range(len(out)):
        own = language == k
        if positives[own].sum() >= LEAST_POSITIVES:
            out[k] = best(own)
    return out


def fit_all(df: DataFrame, labels: DataFrame) -> Network:
    """Fit on all labelled rows. Those that a sample holds whole are fitted on in the
    driver; of more, the sample's network is where all groups start from."""
    sample = labelled_sample(df, labels, "toxic")
    net = fit(sample)
    known = all_labelled(df, labels, "toxic")
    if known.rows == len(sample.labels) or known.positives in (0, known.rows):
        return net
    if not net.output.any():  # a sample with one label only
        net.output[:] = np.random.default_rng(SEED).normal(0, 0.2, len(net.output))
    net = _mean_of_groups(net, known)
    found = _thresholds(net, known, _set_aside())
    net.thresholds[:] = _thresholds(net, known) if found is None else found
    return net


def toxicity_scores(
    df: DataFrame, labels: DataFrame, text: str = "text", name: str = "score"
) -> DataFrame:
    """Add the toxicity score (under a fresh name if taken) to every row.

    Null and empty texts get the score of a text without known words. Repeated
    rows are scored each. The network's size has a bound, given by the buckets',
    and it is broadcast.
    """
    name = fresh(df.columns, name)[0]
    parameters = df.sparkSession.sparkContext.broadcast(vars(fit_all(df, labels)))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(**parameters.value)
        for piece in slices(batches, text):
            found = net.scores(piece.column(text))
            yield extended(piece, **{name: pa.array(found, pa.float64())})

    return bounded_batches(df).mapInArrow(score, with_fields(df, f"`{name}` double"))


@registered("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_scores(docs, read(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (quoted("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
