"""Near-duplicates by consistent weighted sampling.

Features of a text are its runs of five words, weighted by how often the text
has them and by their inverse document frequency: each run's own, counted over
all different texts. Texts are dealt to groups and runs to ranges; a group sends
its runs to their ranges in blocks, each range counts its runs and sends back
those of several texts. Improved consistent weighted sampling draws one feature per hash function with the chance that two texts draw the same
being their weighted Jaccard similarity. Draws are banded; texts that share a
band are compared exactly, and those as similar as the threshold are linked.

Exact copies (the same words in the same order) are one text from the start.
In a bucket of a band, texts are compared with its leaders only: the few that
share most with others, such as the text that copies were made from. That links
most of a group with one comparison each. Buckets that still hold several
classes are finished by a prefix filter over all their texts, which is exact:
it finds every pair of different classes that can reach the threshold, and
copies of one text do not all meet in it, as its order puts rare features first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contestlab.llm.components import components
from contestlab.llm.registry import registered
from contestlab.llm.tables import (
    bounded_batches,
    extended,
    fresh,
    quoted,
    read,
    salted_join,
    shuffled_join,
    slices,
    with_fields,
)
from contestlab.llm.words import Words, batch_words, mix, shingles, uniform
from contestlab.operators.attach import Lookup, attach
from contestlab.sources.scratch import shuffles_freed, written

WIDTH = 5
THRESHOLD = 0.8
BANDS = 16
ROWS = 4
DRAW_ROWS = 1 << 13
SEED = 1
SALTS = 16
PAIR_SALTS = 64
LEADERS = 4
STEPS = 16  # of total weight, from the threshold's part of it to the whole
HOT_ROWS = 256
ORDER_BUCKETS = 1 << 18
FILTER_BITS = 24
GROUP_BYTES = 4 << 20  # of text, per group of texts and per range of runs
LEAST_GROUPS = 64
_FULL = 64  # features of a text that are drawn in full
_CHUNK = 1024  # further features whose bounds are held at once
_ROOM = np.float32(0.01)  # for rounding in single precision


@dataclass(frozen=True)
class Setting:
    """``bands`` of ``rows`` draws: texts at a similarity s share a band with
    chance 1 - (1 - s**rows)**bands, 0.9998 at 0.8 with the defaults."""

    width: int = WIDTH
    threshold: float = THRESHOLD
    bands: int = BANDS
    rows: int = ROWS
    seed: int = SEED


def text_key(words: np.ndarray) -> bytes:
    """16 bytes that stand for the words of a text, in their order."""
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


def _counted(features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct features and their counts."""
    features = np.sort(features)
    new = np.flatnonzero(features[1:] != features[:-1]) + 1
    if len(new) + 1 == len(features):
        return features, np.ones(len(features), np.int64)
    ends = np.concatenate([[0], new, [len(features)]])
    return features[ends[:-1]], np.diff(ends)


def _features(words: Words, width: int) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """For each text: sorted distinct features and their counts; None without words."""
    found, offsets = shingles(words, width)
    places = zip(offsets[:-1].tolist(), offsets[1:].tolist())
    return [_counted(found[a:b]) if a < b else None for a, b in places]


def _runs(texts: pa.Array, width: int):
    """The keys of the texts' words, None without words, and their features."""
    words = batch_words(texts)
    places = zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist())
    keys = [text_key(words.hashes[a:b]) if a < b else None for a, b in places]
    return keys, _features(words, width)


def keyed_texts(docs: DataFrame, text: str, groups: int) -> DataFrame:
    """(s, key, text) of the different texts with words: ``s`` is the group that a
    text is dealt to by its words. A task sends equal texts once, and what several
    tasks sent of one text becomes one row before a group is put together."""

    def key(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for piece in slices(batches, text):
            words = batch_words(piece.column(text))
            rows, keys = [], []
            for i in range(piece.num_rows):
                own = words.hashes[words.offsets[i] : words.offsets[i + 1]]
                if len(own) and (name := text_key(own)) not in seen:
                    seen.add(name)
                    rows.append(i)
                    keys.append(name)
            if rows:
                at = [int.from_bytes(k[:8], "little") % groups for k in keys]
                columns = [pa.array(at, pa.int32()), pa.array(keys, pa.binary())]
                texts = piece.column(text).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*columns, texts], names=["s", "key", "text"])

    sent = docs.select(quoted(text)).mapInArrow(key, "s int, key binary, text string")
    # Dealt by group already, the rows of a key are in one place.
    return sent.repartition("s").groupBy("s", "key").agg(F.min("text").alias("text"))


def _different(table: pa.Table, width: int):
    """Keys and features of the different texts of a group, a slice at a time."""
    seen: set[bytes] = set()
    for piece in slices(table.to_batches(), "text"):
        keys = piece.column("key").to_pylist()
        rows = [i for i, k in enumerate(keys) if k not in seen and not seen.add(k)]
        if rows:
            texts = piece.column("text").take(pa.array(rows))
            yield [keys[i] for i in rows], _features(batch_words(texts), width)


def _packed(values: np.ndarray) -> bytes:
    """64-bit numbers: the lowest byte of each, then the next of each. The upper bytes of
    small ones are runs of zeros, which take next to no room in shuffles and files."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(column: pa.ChunkedArray) -> list[np.ndarray]:
    parts = (np.frombuffer(x, np.uint8).reshape(8, -1).T for x in column.to_pylist())
    return [np.ascontiguousarray(x).view("<u8").ravel() for x in parts]


def _packed_features(features: np.ndarray) -> bytes:
    """Sorted features, as steps from one to the next: the more there are, the smaller."""
    return _packed(np.diff(features, prepend=np.uint64(0)))


def _unpacked_features(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.cumsum(x, dtype=np.uint64) for x in _unpacked(column)]


def _unpacked_counts(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [x.astype(np.int64) for x in _unpacked(column)]


@dataclass(frozen=True)
class Frequencies:
    """``blocks``: (s, texts, features, n), for the texts of group ``s`` the runs
    that several texts have, and in how many; all other runs are in one text. Both are
    packed, the runs as steps. ``texts`` is counted in one block of a group."""

    blocks: DataFrame
    groups: int


def document_frequencies(docs: DataFrame, text: str, setting: Setting) -> tuple[Frequencies, int]:
    """How many different texts have each run, and how many texts have runs. A
    group's runs are counted before they are sent, and nothing is held but one
    group of texts or one range of runs."""
    width = setting.width
    size = docs.agg(F.sum(F.octet_length(quoted(text)).cast("bigint"))).first()[0] or 0
    groups = max(LEAST_GROUPS, size // GROUP_BYTES)

    def send(table: pa.Table) -> pa.Table:
        found, texts = [], 0
        for keys, features in _different(table, width):
            found += [own[0] for own in features]
            texts += len(keys)
        features, counts = np.unique(np.concatenate(found), return_counts=True)
        ranges = ((features >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
        cuts = np.append(np.flatnonzero(np.diff(ranges, prepend=-1)), len(ranges))
        pairs = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        return pa.table(
            {
                "part": pa.array(ranges[cuts[:-1]], pa.int32()),
                "s": pa.array([table.column("s")[0].as_py()] * len(pairs), pa.int32()),
                "texts": pa.array([texts] + [0] * (len(pairs) - 1), pa.int64()),
                "features": pa.array([_packed_features(features[a:b]) for a, b in pairs], pa.binary()),
                "n": pa.array([_packed(counts[a:b]) for a, b in pairs], pa.binary()),
            }
        )

    def count(table: pa.Table) -> pa.Table:
        blocks = _unpacked_features(table.column("features"))
        counts = _unpacked_counts(table.column("n"))
        features, place = np.unique(np.concatenate(blocks), return_inverse=True)
        totals = np.zeros(len(features), np.int64)
        np.add.at(totals, place, np.concatenate(counts))
        own = np.split(totals[place], np.cumsum([len(b) for b in blocks])[:-1])
        return pa.table(
            {
                "s": table.column("s"),
                "texts": table.column("texts"),
                "features": pa.array([_packed_features(b[n > 1]) for b, n in zip(blocks, own)], pa.binary()),
                "n": pa.array([_packed(n[n > 1]) for n in own], pa.binary()),
            }
        )

    fields = "s int, texts bigint, features binary, n binary"
    sent = keyed_texts(docs, text, groups).groupBy("s").applyInArrow(send, f"part int, {fields}")
    blocks = written(sent.groupBy("part").applyInArrow(count, fields), "frequencies")
    return Frequencies(blocks, groups), blocks.agg(F.sum("texts")).first()[0] or 0


def idf(counts: np.ndarray, texts: int) -> np.ndarray:
    return 1.0 + np.log((1.0 + texts) / (1.0 + counts))


def _frequencies_of(features: np.ndarray, known: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Document frequencies of features; those not among the known (sorted) are in one text."""
    if not len(known):
        return np.ones(len(features), np.int64)
    at = np.minimum(np.searchsorted(known, features), len(known) - 1)
    return np.where(known[at] == features, n[at], 1)


def _known(features: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not features:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    known, first = np.unique(np.concatenate(features), return_index=True)
    return known, np.concatenate(n)[first]


@dataclass(frozen=True)
class Weights:
    """Inverse document frequencies. Operators join the blocks to the texts;
    ``of`` collects them, for comparisons on a small corpus."""

    counts: Frequencies
    texts: int

    @cached_property
    def _collected(self) -> tuple[np.ndarray, np.ndarray]:
        table = self.counts.blocks.select("features", "n").toArrow()
        return _known(_unpacked_features(table.column("features")), _unpacked_counts(table.column("n")))

    def of(self, features: np.ndarray) -> np.ndarray:
        return idf(_frequencies_of(features, *self._collected), self.texts)


def inverse_frequencies(counts: Frequencies, texts: int) -> Weights:
    return Weights(counts, texts)


@dataclass
class Draws:
    """What consistent weighted sampling draws per feature and hash function:
    r and c from a gamma distribution with shape two, b uniform. A feature's hash
    says in which row of a table its draws are, and at which column they begin,
    round the row; so two features draw alike with chance 1 / (rows * functions).
    Rows are stored twice over, so that a feature's draws stand together. A draw's
    identity is the feature itself."""

    functions: int
    r: np.ndarray
    log_c: np.ndarray
    b: np.ndarray

    @classmethod
    def table(cls, functions: int, seed: int) -> Draws:
        at = np.arange(DRAW_ROWS * functions, dtype=np.uint64).reshape(-1, functions)
        at = at * np.uint64(8) + np.uint64(seed) * np.uint64(0xA5A5A5A5B)
        u = [uniform(mix(at + np.uint64(k))) for k in range(5)]
        tables = -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3])), u[4]
        return cls(functions, *(np.tile(x.astype(np.float32), 2).ravel() for x in tables))

    @cached_property
    def windows(self) -> list[np.ndarray]:
        """The tables of r, c, b and the lower bounds by the place a feature's draws begin."""
        tables = self.r, self.log_c, self.b, self.log_c - self.r
        return [np.lib.stride_tricks.sliding_window_view(x, self.functions) for x in tables]

    def sample(self, features: np.ndarray, log_weights: np.ndarray) -> np.ndarray:
        """One 64-bit identity of (feature, level) per hash function. A value is at least
        log c - r - log weight. So the first features are drawn in full, and of the
        others the draws whose bound, with room for rounding, is below the least value."""
        n = self.functions
        r, log_c, b, low = self.windows
        row, turn = features % np.uint64(DRAW_ROWS), (features >> np.uint64(40)) % np.uint64(n)
        places = (row * np.uint64(2 * n) + turn).astype(np.int64)
        own, logs = places[:_FULL], log_weights[:_FULL, None]
        level, value = self._drawn(r[own], log_c[own], b[own], logs)
        where, columns = value.argmin(axis=0), np.arange(n)
        best, level = value[where, columns], level[where, columns]
        for at in range(_FULL, len(features), _CHUNK):
            own, logs = places[at : at + _CHUNK], log_weights[at : at + _CHUNK]
            bound = low[own]
            bound -= logs[:, None]
            # As places in the whole of ``bound``, feature by feature.
            open_ = np.flatnonzero(bound <= best + _ROOM)
            feature = open_ // n
            column = open_ - feature * n
            draw = own[feature] + column
            levels, values = self._drawn(self.r[draw], self.log_c[draw], self.b[draw], logs[feature])
            least = best.copy()
            np.minimum.at(least, column, values)
            # Of equal values the first counts, so it is written last.
            found = np.flatnonzero((values == least[column]) & (values < best[column]))[::-1]
            changed = column[found]
            level[changed], where[changed] = levels[found], at + feature[found]
            best = least
        return mix(features[where] ^ mix(level.astype(np.int64).astype(np.uint64)))

    @staticmethod
    def _drawn(r, log_c, b, log_weights) -> tuple[np.ndarray, np.ndarray]:
        """Levels and values of draws."""
        level = np.floor(log_weights / r + b)
        return level, log_c - r * (level - b + 1)


@lru_cache(maxsize=1)
def _draws(functions: int, seed: int) -> Draws:
    """The table, once for all groups of a task."""
    return Draws.table(functions, seed)


def band_hashes(draws: np.ndarray, setting: Setting) -> list:
    """The hashes of all bands, of one text or of each of several."""
    parts = draws.reshape(*draws.shape[:-1], setting.bands, setting.rows)
    out = np.arange(1, setting.bands + 1, dtype=np.uint64)
    for k in range(setting.rows):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[..., k])
    return out.astype(np.int64).tolist()


def signatures(docs: DataFrame, weights: Weights, text: str, setting: Setting) -> DataFrame:
    """(key, bands, df) of the different texts with words: ``key`` is 16 bytes
    that stand for the words in their order, ``df`` has the document frequencies
    of the text's features, in order of the features, as 64-bit integers."""
    texts, functions = weights.texts, setting.bands * setting.rows

    def sign(group: pa.Table, blocks: pa.Table) -> pa.Table:
        draws = _draws(functions, setting.seed)
        known = _known(_unpacked_features(blocks.column("features")), _unpacked_counts(blocks.column("n")))
        names, bands, frequencies = [], [], []
        for keys, features in _different(group, setting.width):
            names += keys
            drawn = []
            for own in features:
                n = _frequencies_of(own[0], *known)
                logs = np.log(own[1] * idf(n, texts)).astype(np.float32)
                drawn.append(draws.sample(own[0], logs))
                frequencies.append(n.tobytes())
            bands += band_hashes(np.stack(drawn), setting)
        return pa.table(
            {
                "key": pa.array(names, pa.binary()),
                "bands": pa.array(bands, pa.list_(pa.int64())),
                "df": pa.array(frequencies, pa.binary()),
            }
        )

    group = keyed_texts(docs, text, weights.counts.groups).groupBy("s")
    both = group.cogroup(weights.counts.blocks.groupBy("s"))
    return both.applyInArrow(sign, "key binary, bands array<bigint>, df binary")


def similarity(a, weights_a: np.ndarray, b, weights_b: np.ndarray) -> float:
    """Sum of the smaller over sum of the larger weights of two texts' features."""
    features, first, place = np.unique(
        np.concatenate([a[0], b[0]]), return_index=True, return_inverse=True
    )
    counts = np.zeros((2, len(features)))
    counts[0, place[: len(a[0])]] = a[1]
    counts[1, place[len(a[0]) :]] = b[1]
    w = np.concatenate([weights_a, weights_b])[first]
    return float((counts.min(axis=0) * w).sum() / (counts.max(axis=0) * w).sum())


def weighted_jaccard(a, b, weights: Weights) -> float:
    return similarity(a, weights.of(a[0]), b, weights.of(b[0]))


def members_of_buckets(texts: DataFrame) -> DataFrame:
    """(bucket, key, mass) for every band bucket that two texts or more share;
    ``mass`` is the size of all buckets that the text is in."""
    members = texts.select("key", F.posexplode("bands").alias("band", "value")).select(
        F.xxhash64("band", "value").alias("bucket"), "key"
    )
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(salted_join(members, sizes, ["bucket"], SALTS), "shared")
    mass = shared.groupBy("key").agg(F.sum("n").alias("mass"))
    return shuffled_join(shared.drop("n"), mass, "key")


def candidate_texts(docs: DataFrame, live: DataFrame, text: str, setting: Setting) -> DataFrame:
    """(key, text) of the texts in shared buckets, one row each. A bitmap of
    fixed size lets most other texts stay where they are; those it lets pass by
    mistake fall out in the join."""
    keys = live.select("key").distinct()
    at = F.crc32("key") % (1 << FILTER_BITS)
    bits = (
        keys.select(at.alias("at"))
        .groupBy(F.expr("at div 64").cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(1 << FILTER_BITS >> 6, np.uint64)
    bitmap[bits.column("word").to_numpy()] = bits.column("bits").to_numpy().astype(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for piece in slices(batches, text):
            found = batch_words(piece.column(text))
            rows, own_keys = [], []
            for i in range(piece.num_rows):
                own = found.hashes[found.offsets[i] : found.offsets[i + 1]]
                if len(own):
                    key = text_key(own)
                    bit = crc32(key) % (1 << FILTER_BITS)
                    if int(words[bit >> 6]) >> (bit & 63) & 1:
                        rows.append(i)
                        own_keys.append(key)
            if rows:
                texts = piece.column(text).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own_keys, pa.binary()), texts], names=["key", "text"]
                )

    passed = docs.select(quoted(text)).mapInArrow(pick, "key binary, text string")
    first = passed.groupBy("key").agg(F.min("text").alias("text"))
    return shuffled_join(first, keys, "key")


def _weights_in(df: pa.Scalar, texts: int) -> np.ndarray:
    return idf(np.frombuffer(df.as_py(), np.int64), texts)


def verified(
    pairs: DataFrame, texts: DataFrame, n: int, setting: Setting
) -> DataFrame:
    """The pairs (a, c) whose texts are similar enough. A leader's text is sent
    once per share of its pairs, not once per pair."""
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("c"), F.lit(PAIR_SALTS)))
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"), F.col("df").alias("df_a"))
    right = texts.select(F.col("key").alias("c"), F.col("text").alias("text_c"), F.col("df").alias("df_c"))
    leaders = shuffled_join(dealt.select("a", "salt").distinct(), left, "a")
    both = shuffled_join(shuffled_join(dealt, right, "c"), leaders, ["a", "salt"])
    both = both.select("a", "c", "text_a", "df_a", "text_c", "df_c")

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(slices([batch], "text_a"), "text_c"):
                # Rows of a leader stand together, so its features are kept.
                right_runs = _features(batch_words(piece.column("text_c")), setting.width)
                known = (None, None, None)
                similar = []
                for i in range(piece.num_rows):
                    a = piece.column("a")[i]
                    if known[0] != a:
                        words = batch_words(piece.column("text_a").slice(i, 1))
                        runs = _features(words, setting.width)[0]
                        known = (a, runs, _weights_in(piece.column("df_a")[i], n))
                    own = _weights_in(piece.column("df_c")[i], n)
                    similar.append(
                        similarity(known[1], known[2], right_runs[i], own) >= setting.threshold
                    )
                yield piece.select(["a", "c"]).filter(pa.array(similar, pa.bool_()))

    return both.mapInArrow(verify, "a binary, c binary")


def open_members(live: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of buckets whose texts are not all of one class, with classes."""
    labelled = shuffled_join(live, classes, "key", "left")
    labelled = labelled.withColumn("class", F.coalesce("class", "key"))
    ends = labelled.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    open_ = ends.where("low <> high").select("bucket")
    return salted_join(labelled, open_, ["bucket"], SALTS)


def pairs_with_leaders(live: DataFrame) -> DataFrame:
    """(a, c): every text with the leaders of its buckets, the texts that share
    most with others."""
    slot = F.pmod(F.xxhash64("key"), F.lit(LEADERS))
    leader = F.max(F.struct("mass", "key")).alias("leader")
    leaders = live.groupBy("bucket", slot.alias("slot")).agg(leader)
    leaders = leaders.select("bucket", F.col("leader.key").alias("a"))
    met = salted_join(live.select("bucket", F.col("key").alias("c")), leaders, ["bucket"], SALTS)
    pairs = met.where("a <> c").select("a", "c").distinct()
    # Of two leaders that meet, the one with the smaller key asks.
    back = pairs.select(F.col("c").alias("a"), F.col("a").alias("c"), F.lit(True).alias("back"))
    known = shuffled_join(pairs, back, ["a", "c"], "left")
    return known.where("back IS NULL OR a < c").select("a", "c")


def order_counts(texts: DataFrame, setting: Setting) -> np.ndarray:
    """How often features occur in these texts, by a hash into a fixed number of
    buckets: the order of the prefix filter."""
    width = setting.width

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(ORDER_BUCKETS, np.int64)
        for piece in slices(batches, "text"):
            found, _ = shingles(batch_words(piece.column("text")), width)
            at = (found % np.uint64(ORDER_BUCKETS)).astype(np.int64)
            totals += np.bincount(at, minlength=ORDER_BUCKETS)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(totals[some])], names=["bucket", "n"]
        )

    counts = texts.select("text").mapInArrow(count, "bucket int, n bigint")
    table = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(ORDER_BUCKETS, np.int64)
    out[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


def pairs_by_prefix(
    texts: DataFrame, n: int, setting: Setting
) -> DataFrame:
    """(a, c): all pairs of different classes in ``texts`` (key, class, text, df)
    that can reach the threshold.

    With all features in one order, rarest first, two similar texts share a
    feature before the point where what is left of either weighs less than the
    threshold's part of it. From the first shared feature on, both have to hold
    what the threshold asks of their overlap; copies of one text, which share
    their common features late, mostly do not.
    """
    tables = texts.sparkSession.sparkContext.broadcast(order_counts(texts, setting))

    def prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = tables.value
        for piece in slices(batches, "text"):
            place, features, rests, totals = [], [], [], []
            for i, own in enumerate(_features(batch_words(piece.column("text")), setting.width)):
                found, times = own
                rank = np.lexsort((found, counts[(found % np.uint64(ORDER_BUCKETS)).astype(np.int64)]))
                weight = (times * _weights_in(piece.column("df")[i], n))[rank]
                left = weight.sum() - np.cumsum(weight)
                # The feature after which too little is left is the last of the prefix.
                last = int(np.argmax(left < (setting.threshold - 1e-6) * weight.sum()))
                place.append(np.full(last + 1, i))
                features.append(found[rank[: last + 1]].astype(np.int64))
                rests.append((left + weight)[: last + 1])
                totals.append(np.full(last + 1, weight.sum()))
            if place:
                at = pa.array(np.concatenate(place))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(features)),
                        piece.column("key").take(at),
                        piece.column("class").take(at),
                        pa.array(np.concatenate(rests)),
                        pa.array(np.concatenate(totals)),
                    ],
                    names=["feature", "a", "a_class", "a_rest", "a_total"],
                )

    fields = "feature bigint, a binary, a_class binary, a_rest double, a_total double"
    left = texts.mapInArrow(prefixes, fields)
    left = written(left, "prefixes")
    # A feature whose texts are all of one class pairs none.
    ends = left.groupBy("feature").agg(F.min("a_class").alias("low"), F.max("a_class").alias("high"))
    several = ends.where("low <> high").select("feature")
    return reaching_pairs(salted_join(left, several, ["feature"], SALTS), setting.threshold)


def reaching_pairs(left: DataFrame, threshold: float) -> DataFrame:
    """(a, c), a < c: texts of different classes that share a feature of ``left``
    (feature, a, a_class, a_rest, a_total) from which on both hold what the
    threshold asks of their overlap.

    Of two texts at the threshold, the overlap is a fixed part of both totals
    together. So a text whose rest is small asks only for texts that are as much
    lighter, down to the threshold's part of it; the lighter of two texts is looked up by
    steps of its total. Texts of one template, which weigh alike and share too
    little, do not meet. What still meets in a step that many texts are in is
    spread: the asking rows are dealt, the others copied.
    """
    part = threshold / (1 + threshold) * (1 - 1e-6)
    step = float(-np.log(threshold) / STEPS)
    # The heaviest partner that the rest allows, if it is not heavier than the text.
    heaviest = F.least("a_total", F.col("a_rest") / F.lit(part) - F.col("a_total"))
    lightest = F.col("a_total") * F.lit(threshold * (1 - 1e-6))
    steps = F.sequence(
        F.floor(F.log(lightest) / F.lit(step)).cast("int"),
        F.floor(F.log(heaviest) / F.lit(step)).cast("int"),
    )
    right = left.withColumnsRenamed({n: n.replace("a", "c", 1) for n in left.columns if n[0] == "a"})
    at_c = F.floor(F.log("c_total") / F.lit(step)).cast("int")
    homes = written(right.withColumn("step", at_c), "homes")
    hot = homes.groupBy("feature", "step").agg(F.count("*").alias("n"))
    salts = F.least(F.lit(PAIR_SALTS), F.ceil(F.col("n") / HOT_ROWS)).cast("int")
    hot = hot.select("feature", "step", salts.alias("salts"))
    asking = left.where(heaviest >= lightest).withColumn("step", F.explode(steps))
    asking = shuffled_join(asking, hot, ["feature", "step"])
    asking = asking.withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int"))
    copied = shuffled_join(homes, hot, ["feature", "step"]).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    )
    met = shuffled_join(asking, copied.drop("salts"), ["feature", "step", "salt"])
    reach = F.least("a_rest", "c_rest") >= (F.col("a_total") + F.col("c_total")) * F.lit(part)
    lighter = F.expr("c_total < a_total OR c_total = a_total AND a < c")
    found = met.where(F.expr("a_class <> c_class") & lighter & reach)
    return found.select(F.least("a", "c").alias("a"), F.greatest("a", "c").alias("c")).distinct()


def links_and_classes(
    live: DataFrame, texts: DataFrame, n: int, setting: Setting
) -> tuple[DataFrame, DataFrame]:
    """(a, c) links, and (key, class) of the linked texts."""
    none = live.sparkSession.createDataFrame([], "key binary, class binary")
    pairs = written(pairs_with_leaders(live), "pairs")
    links = written(verified(pairs, texts, n, setting), "links")
    classes = merged(none, links)
    rest = open_members(live, classes).select("key", "class").distinct()
    rest = written(shuffled_join(rest, texts, "key"), "rest")
    # Pairs with a leader have been compared already.
    more = pairs_by_prefix(rest, n, setting)
    both_ways = pairs.unionByName(pairs.select(F.col("c").alias("a"), F.col("a").alias("c")))
    more = written(shuffled_join(more, both_ways, ["a", "c"], "left_anti"), "pairs")
    new = written(verified(more, texts, n, setting), "links")
    return links.unionByName(new), classes if new.isEmpty() else merged(classes, new)


def merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(key, class) after more links: classes that a link joins become one."""
    ends = links.select(F.col("a").alias("u"), F.col("c").alias("v"))
    for end in ("u", "v"):
        known = classes.select(F.col("key").alias(end), F.col("class").alias("to"))
        ends = shuffled_join(ends, known, end, "left")
        ends = ends.withColumn(end, F.coalesce("to", end)).drop("to")
    roots = components(ends)
    moved = roots.select(F.col("node").alias("class"), F.col("root").alias("to"))
    old = shuffled_join(classes, moved, "class", "left")
    old = old.select("key", F.coalesce("to", "class").alias("class"))
    new = roots.select(F.col("node").alias("key"), F.col("root").alias("class"))
    every = old.unionByName(new)
    every = every.unionByName(every.select(F.col("class").alias("key"), "class"))
    return written(every.groupBy("key").agg(F.min("class").alias("class")), "classes")


@dataclass(frozen=True)
class Classes:
    """``rows``: (doc_id, key) of all rows; ``several``: (key, class_id, kept,
    links_checked, n_copies) of the texts with links or copies, where ``kept`` is the
    key that the class keeps."""

    rows: DataFrame
    several: DataFrame


def row_keys(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``key``, null without words, in place of the text."""
    kept = [c for c in docs.columns if c != text]

    def key(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            words = batch_words(piece.column(text))
            parts = (words.hashes[a:b] for a, b in zip(words.offsets[:-1], words.offsets[1:]))
            keys = [text_key(own) if len(own) else None for own in parts]
            yield extended(piece.select(kept), key=pa.array(keys, pa.binary()))

    return docs.mapInArrow(key, with_fields(docs.select(*map(quoted, kept)), "key binary"))


def text_classes(
    docs: DataFrame, setting: Setting = Setting(), doc_id: str = "doc_id", text: str = "text"
) -> Classes:
    """The classes, by jobs that run at once; what each has shuffled goes with it."""
    light = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    with shuffles_freed(docs.sparkSession):
        return _text_classes(bounded_batches(light), setting)


def _text_classes(light: DataFrame, setting: Setting) -> Classes:
    rows = written(row_keys(light, "text"), "rows")
    texts = (
        rows.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"))
    )
    texts = written(texts, "texts")
    counts, n = document_frequencies(light, "text", setting)
    weights = inverse_frequencies(counts, n)
    signed = written(signatures(light, weights, "text", setting), "signed")
    live = written(members_of_buckets(signed), "live")
    bodies = candidate_texts(light, live, "text", setting)
    bodies = written(shuffled_join(bodies, signed.select("key", "df"), "key"), "bodies")
    links, classes = links_and_classes(live, bodies, n, setting)

    ends = links.select(F.explode(F.array("a", "c")).alias("key"))
    checked = ends.groupBy("key").agg(F.count("*").alias("links_checked"))
    per_text = shuffled_join(texts.select("key", "first_id", "n_copies"), classes, "key", "left")
    per_text = (
        shuffled_join(per_text, checked, "key", "left")
        .where("links_checked > 0 OR n_copies > 1")
        .withColumn("class", F.coalesce("class", "key"))
    )
    # A null id is after all others.
    order = F.struct(F.col("first_id").isNull(), "first_id", "key")
    least = per_text.groupBy("class").agg(F.min(order).alias("least"))
    several = salted_join(per_text, least, ["class"], SALTS).select(
        F.hex("key").alias("key"),
        F.col("least.first_id").alias("class_id"),
        F.hex("least.key").alias("kept"),
        "links_checked",
        "n_copies",
    )
    return Classes(rows.select("doc_id", F.hex("key").alias("key")), several)


def near_duplicates(
    docs: DataFrame, setting: Setting = Setting(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, key, class_id, links_checked, n_copies): one row per row of ``docs``.

    ``key`` stands for the text's words, ``class_id`` is the smallest id of the
    class, ``links_checked`` the links of this text that were compared and found
    similar while classes were built: no more than the different texts similar to
    it, and fewer in a large class, where a few links make the class whole.
    ``n_copies`` is the number of rows with exactly its words. Null and empty texts,
    and texts without words, are each a class of their own, with null key. A
    text of fewer than ``width`` words has one feature, all its words. A null id
    is never the smallest unless a class has no other. Repeated rows are copies.
    No rows give no rows. Other columns are ignored.
    """
    found = text_classes(docs, setting, doc_id, text)
    values = ("class_id", "links_checked", "n_copies")
    out = attach(found.rows, Lookup(found.several, {"key": "key"}, {c: c for c in values}))
    return out.select(
        "doc_id",
        "key",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("links_checked", F.lit(0)).cast("bigint").alias("links_checked"),
        F.coalesce("n_copies", F.lit(1)).cast("bigint").alias("n_copies"),
    )


def keepers(
    docs: DataFrame, setting: Setting = Setting(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of ``docs`` per class, with all its columns: the row with the
    smallest id, of rows that repeat id and words the one with the first text
    by code point, of rows that are equal in both any. Rows without words stay.
    """
    found = text_classes(docs, setting, doc_id, text)
    key, kept, least = fresh(docs.columns, "_key", "_kept", "_least")

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text):
            words = batch_words(piece.column(text))
            parts = (words.hashes[a:b] for a, b in zip(words.offsets[:-1], words.offsets[1:]))
            keys = [text_key(own).hex().upper() if len(own) else None for own in parts]
            yield extended(piece, **{key: pa.array(keys, pa.string())})

    rows = docs.mapInArrow(keyed, with_fields(docs, f"`{key}` string"))
    out = attach(rows, Lookup(found.several, {"key": key}, {"kept": kept, "class_id": least}))
    mine = (quoted(kept) == quoted(key)) & quoted(doc_id).eqNullSafe(quoted(least))
    alone = quoted(kept).isNull()
    # What is left of a class with copies is one row, or rows that repeat an id.
    copies = out.where(mine).groupBy(key).agg(
        F.min_by(F.struct(*map(quoted, docs.columns)), quoted(text)).alias("row")
    )
    return out.where(alone).select(*map(quoted, docs.columns)).unionByName(copies.select("row.*"))


@registered("op1_near_dedup")
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "links_checked", "n_copies")
