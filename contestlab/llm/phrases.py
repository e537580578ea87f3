"""Phrase collocations, counted with HAT-tries.

Four passes read the texts. The first counts words, the second pairs of frequent
words, the third triples of frequent pairs, both by 40-bit codes that several may
share; the fourth counts, exactly, phrases all of whose pairs and triples have
frequent codes. A phrase is never more frequent than its parts, so no other can be
a candidate. What is frequent goes to the next pass as a bitmap of fixed size; a
rare word, pair or triple that passes it by mistake costs time only.

A task counts phrases in a trie of word ids whose leaves are hash containers: a
container of many phrases bursts into a node with a container for each next
word. Above its limit the trie spills whole subtrees, largest first, each as a
run of phrases in their order. Runs meet by prefix, the first three words of a
phrase, so a common word or pair is spread over many partitions, and are merged
there.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contestlab.llm.registry import registered
from contestlab.llm.tables import bounded_batches, quoted, read, slices
from contestlab.operators.attach import Lookup, attach, measured
from contestlab.sources.scratch import written

LONGEST = 4
LEAST = 30
INSIDE_PERCENT = 80
SCALE = 2_000_000
KEPT = 2000
NO_LANG = "und"
FILTER_BITS = 26
CHUNK_BYTES = 1 << 20
TRIE_ENTRIES = 600_000
BURST_ENTRIES = 4096
HELD_WORDS = 400_000
HELD_CODES = 1 << 22
RUN_ROWS = 50_000
PART_BITS = 6  # codes are dealt to at least so many parts, as a power of two
PART_WORDS = 1 << 20  # of all texts, per part
_ID_BITS = 21
_STEP = 65_599  # of the codes of pairs and triples
_CODE_BITS = 40

# Words are split at spaces and tabs, pieces at these signs and at line ends.
_SIGNS = b".,;:!?\n\x0b\x0c\r"
_EDGE = re.compile(rb"[ \t.,;:!?\n-\r]")
_SIGN = b"."  # stands for all of them
_PLAIN = bytes.maketrans(
    _SIGNS + b"\t" + ascii_uppercase.encode(),
    _SIGN * len(_SIGNS) + b" " + ascii_lowercase.encode(),
)


def tokens(data: bytes, chunk: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """Words of lower-cased ``data`` in order, and ``_SIGN`` where a piece ends, some
    at a time; it is cut beside a sign or white space only."""
    start = 0
    while start < len(data):
        edge = _EDGE.search(data, start + chunk)
        end = edge.start() if edge else len(data)
        plain = data[start:end].translate(_PLAIN)
        yield plain.replace(_SIGN, b" " + _SIGN + b" ").split()
        start = end


def by_lang(piece: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """The texts of each language in (text, lang), with line ends between them."""
    parts: dict[str, list[bytes]] = {}
    texts = piece.column("text").cast(pa.large_binary())
    for lang, text in zip(piece.column("lang").to_pylist(), texts.to_pylist()):
        if text:
            parts.setdefault(lang, []).append(text)
    for lang, found in parts.items():
        yield lang, b"\n".join(found)


def texts_of(docs: DataFrame, text: str, lang: str) -> DataFrame:
    named = F.coalesce(quoted(lang).cast("string"), F.lit(NO_LANG))
    return bounded_batches(docs.select(quoted(text).alias("text"), named.alias("lang")))


RUN = "lang string, phrase string, f bigint"


def word_runs(texts: DataFrame, held: int = HELD_WORDS) -> DataFrame:
    """Counts of words by language, summed within a task where they fit."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}

        def emptied() -> Iterator[pa.RecordBatch]:
            for lang, own in words.items():
                found = [w for w in own if w != _SIGN]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(found), pa.string()),
                        pa.array(found, pa.binary()).cast(pa.string()),
                        pa.array([own[w] for w in found], pa.int64()),
                    ],
                    names=["lang", "phrase", "f"],
                )
            words.clear()

        for piece in slices(batches, "text"):
            for lang, data in by_lang(piece):
                own = words.setdefault(lang, Counter())
                for part in tokens(data):
                    own.update(part)
                    if sum(map(len, words.values())) > held:
                        yield from emptied()
                        own = words.setdefault(lang, Counter())
        yield from emptied()

    return texts.mapInArrow(count, RUN)


def bitmap_of(places: DataFrame, bits: int = FILTER_BITS) -> Broadcast:
    """The bits that are set: at most 2**bits, however many rows there are."""
    table = (
        places.groupBy(F.expr(f"at % {1 << bits} div 64").cast("int").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(at % {1 << bits} % 64 as int))")).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(1 << bits >> 6, np.uint64)
    bitmap[table.column("word").to_numpy()] = table.column("bits").to_numpy().astype(np.uint64)
    return places.sparkSession.sparkContext.broadcast(bitmap)


def frequent_words(words: DataFrame, bits: int = FILTER_BITS) -> Broadcast:
    code = F.crc32(F.concat(F.col("lang"), F.lit("\n"), F.col("phrase")).cast("binary"))
    return bitmap_of(words.select(code.alias("at")), bits)


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of numbers of up to ``_CODE_BITS`` bits, the lowest seven bits first, the
    highest bit set in all but a number's last byte; and where each number ends."""
    sizes = np.ones(len(values), np.int64)
    for shift in range(7, _CODE_BITS, 7):
        sizes += values >= 1 << shift
    ends = np.cumsum(sizes)
    out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    left, at, own = sizes, ends - sizes, values
    while len(own):
        more = left > 1
        out[at] = own & 127 | more.astype(np.int64) << 7
        left, at, own = left[more] - 1, at[more] + 1, own[more] >> 7
    return out, ends


def numbers_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers whose ``varints`` these are, and where each ends."""
    ends = np.flatnonzero(data < 128) + 1
    starts = np.append(0, ends[:-1])
    place = np.arange(len(data)) - np.repeat(starts, ends - starts)
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * place, starts), ends


BLOCK = "part int, part_bits int, codes binary, n binary"


def code_blocks(codes: np.ndarray, part_bits: int) -> Iterator[pa.RecordBatch]:
    """Counts of codes: a block for each part, the codes with the same lowest
    ``part_bits``, of what is above those: steps from one to the next, and counts."""
    high = _CODE_BITS - part_bits
    turned = (codes & (1 << part_bits) - 1) << high | codes >> part_bits
    turned, counts = np.unique(turned, return_counts=True)
    if not len(turned):
        return
    parts, rest = turned >> high, turned & (1 << high) - 1
    cuts = np.flatnonzero(np.diff(parts, prepend=-1))
    steps = np.diff(rest, prepend=0)
    steps[cuts] = rest[cuts]
    columns = []
    for values in (steps, counts):
        data, ends = varints(values)
        offsets = np.append(0, np.append(ends[cuts[1:] - 1], ends[-1])).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        columns.append(pa.Array.from_buffers(pa.binary(), len(cuts), buffers))
    kinds = pa.array(parts[cuts], pa.int32()), pa.array([part_bits] * len(cuts), pa.int32())
    batch = pa.RecordBatch.from_arrays([*kinds, *columns], names=["part", "part_bits", "codes", "n"])
    rows = max(1, len(cuts) * RUN_ROWS // len(turned))
    for at in range(0, len(cuts), rows):
        yield batch.slice(at, rows)


def summed_codes(blocks: pa.Table, least: int) -> np.ndarray:
    """The codes of a part that its blocks have often enough together."""
    part, part_bits = (blocks.column(c)[0].as_py() for c in ("part", "part_bits"))
    own, counts = blocks.column("codes").to_pylist(), blocks.column("n").to_pylist()
    steps, ends = numbers_of(np.frombuffer(b"".join(own), np.uint8))
    n = numbers_of(np.frombuffer(b"".join(counts), np.uint8))[0]
    # Steps add up within a block.
    run = np.cumsum(steps)
    firsts = np.searchsorted(ends, np.cumsum([0, *map(len, own[:-1])]), "right")
    run -= np.repeat(run[firsts] - steps[firsts], np.diff(np.append(firsts, len(steps))))
    order = np.argsort(run)
    run, n = run[order], n[order]
    at = np.flatnonzero(np.diff(run, prepend=-1))
    often = np.add.reduceat(n, at) >= least
    return run[at[often]] << part_bits | part


def frequent_pairs(runs: DataFrame, least: int, bits: int = FILTER_BITS) -> Broadcast:
    """The pairs or triples, in blocks by part, whose code occurs often enough."""

    def often(blocks: pa.Table) -> pa.Table:
        return pa.table({"at": pa.array(summed_codes(blocks, least), pa.int64())})

    return bitmap_of(runs.groupBy("part").applyInArrow(often, "at bigint"), bits)


class _Ids(dict):
    """Ids of the frequent words of a language, from 1; 0 for signs and all
    other words, which end a phrase."""

    def __init__(self, lang: str, bitmap: np.ndarray, bits: int):
        self.seed, self.bitmap, self.bits = crc32(lang.encode() + b"\n"), bitmap, bits
        self.words: list[bytes] = [b""]
        self.codes = array("q", [0])

    def __missing__(self, token: bytes) -> int:
        code = crc32(token, self.seed)
        at = code % (1 << self.bits)
        if token != _SIGN and int(self.bitmap[at >> 6]) >> (at & 63) & 1:
            self.words.append(token)
            self.codes.append(code)
            self[token] = len(self.words) - 1
        else:
            self[token] = 0
        return self[token]

    def codes_of(self, own: np.ndarray, size: int) -> np.ndarray:
        """The codes of all windows of ``size`` ids."""
        n = max(0, len(own) - size + 1)
        one = np.frombuffer(self.codes, np.int64)[own]
        out = one[:n]
        for k in range(1, size):
            out = (out * _STEP + one[k : n + k]) % (1 << _CODE_BITS)
        return out

    def marked(self, own: np.ndarray, known: list[np.ndarray]) -> list[np.ndarray]:
        """Which windows of two ids, of three, ... are frequent by the bitmaps ``known``
        of those sizes, and so are all windows inside; at last, which windows of one id
        more have frequent windows inside."""
        marks = (own[:-1] > 0) & (own[1:] > 0)
        out = []
        for size, bitmap in enumerate(known, 2):
            at = self.codes_of(own, size) % (1 << self.bits)
            marks = marks & (bitmap[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) > 0)
            out.append(marks)
            marks = marks[:-1] & marks[1:]
        return [*out, marks]


def numbered(
    batches: Iterable[pa.RecordBatch], bitmap: np.ndarray, bits: int, held: int, chunk: int
) -> Iterator[tuple[int, str, _Ids, np.ndarray, int]]:
    """(era, lang, ids, own, seen): the texts as ids, a chunk at a time. ``own`` begins
    with the last ``seen`` words of the chunk before. A new era gives all ids anew."""
    era, known = 0, {}
    for piece in slices(batches, "text"):
        for lang, data in by_lang(piece):
            behind: list[bytes] = []
            for part in tokens(data, chunk):
                if sum(map(len, known.values())) > held:
                    era += 1
                    known.clear()
                if lang not in known:
                    known[lang] = _Ids(lang, bitmap, bits)
                found = behind + part
                own = np.fromiter(map(known[lang].__getitem__, found), np.int64, len(found))
                yield era, lang, known[lang], own, len(behind)
                behind = found[-(LONGEST - 1) :]


def starts_of(joined: np.ndarray, size: int, seen: int) -> np.ndarray:
    """Where phrases of ``size`` words start that end behind the first ``seen``
    words; ``joined`` says which words go on with the word behind them."""
    n = len(joined) - size + 2
    first = max(0, seen - size + 1)
    if n <= first:
        return np.zeros(0, np.int64)
    inside = joined[first:n].copy()
    for k in range(1, size - 1):
        inside &= joined[first + k : n + k]
    return np.flatnonzero(inside) + first


class HatTrie:
    """Counts of phrases as word ids. The root has a child by first word: a hash
    container of the words behind it, packed into one number, or, once that has
    burst, a node with a container by second word."""

    def __init__(self, burst: int = BURST_ENTRIES):
        self.root: dict[int, dict] = {}
        self.sizes: dict[int, int] = {}
        self.nodes: set[int] = set()
        self.burst, self.entries = burst, 0

    def add(self, first: np.ndarray, rest: np.ndarray) -> None:
        """Count phrases: ``rest`` has the second word highest, 0 for none."""
        order = np.lexsort((rest, first))
        first, rest = first[order], rest[order]
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(first))).tolist()
        first, rest = first[at], rest[at].tolist()
        cuts = np.flatnonzero(np.diff(first, prepend=-1)).tolist()
        for word, a, b in zip(first[cuts].tolist(), cuts, [*cuts[1:], len(rest)]):
            self._count(word, rest[a:b], counts[a:b])

    def _count(self, word: int, rest: list[int], counts: list[int]) -> None:
        child = self.root.setdefault(word, {})
        if word in self.nodes:
            grown = 0
            for key, n in zip(rest, counts):
                container = child.setdefault(key >> 2 * _ID_BITS, {})
                grown -= len(container)
                container[key] = container.get(key, 0) + n
                grown += len(container)
        else:
            grown = -len(child)
            for key, n in zip(rest, counts):
                child[key] = child.get(key, 0) + n
            grown += len(child)
            if len(child) > self.burst:
                node: dict[int, dict] = {}
                for key, n in child.items():
                    node.setdefault(key >> 2 * _ID_BITS, {})[key] = n
                self.root[word] = node
                self.nodes.add(word)
        self.sizes[word] = self.sizes.get(word, 0) + grown
        self.entries += grown

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Take out whole subtrees, largest first, until ``keep`` entries are left:
        their first words, the packed words behind them, and the counts."""
        words: list[int] = []
        lengths: list[int] = []
        rest: list[int] = []
        counts: list[int] = []
        for word in sorted(self.sizes, key=self.sizes.__getitem__, reverse=True):
            if self.entries <= keep:
                break
            child = self.root.pop(word)
            words.append(word)
            lengths.append(self.sizes.pop(word))
            self.entries -= lengths[-1]
            for container in child.values() if word in self.nodes else [child]:
                rest.extend(container)
                counts.extend(container.values())
            self.nodes.discard(word)
        return (
            np.repeat(np.array(words, np.int64), lengths),
            np.array(rest, np.int64),
            np.array(counts, np.int64),
        )


def sorted_run(
    lang: str, words: list[bytes], spilled: tuple[np.ndarray, np.ndarray, np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """The phrases of some subtrees in order of their words, some at a time."""
    first, rest, counts = spilled
    mask = (1 << _ID_BITS) - 1
    ids = np.stack([first, *(rest >> shift & mask for shift in (2 * _ID_BITS, _ID_BITS, 0))])
    spelled = pa.array(words, pa.binary())
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    packed = rank[ids[1]] << 2 * _ID_BITS | rank[ids[2]] << _ID_BITS | rank[ids[3]]
    order = np.lexsort((packed, rank[first]))
    for at in range(0, len(order), RUN_ROWS):
        own = ids[:, order[at : at + RUN_ROWS]]
        parts = [
            pc.if_else(pa.array(i > 0), spelled.take(pa.array(i)), pa.scalar(None, pa.binary()))
            for i in own
        ]
        phrases = pc.binary_join_element_wise(
            *parts, pa.scalar(b" ", pa.binary()), null_handling="skip"
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(phrases), pa.string()),
                phrases.cast(pa.string()),
                pa.array(counts[order[at : at + RUN_ROWS]]),
            ],
            names=["lang", "phrase", "f"],
        )


def code_runs(
    texts: DataFrame,
    frequent: Broadcast,
    known: tuple[Broadcast, ...] = (),
    bits: int = FILTER_BITS,
    entries: int = HELD_CODES,
    held: int = HELD_WORDS,
    chunk: int = CHUNK_BYTES,
    part_bits: int = PART_BITS,
) -> DataFrame:
    """Counts by code, in blocks, of the pairs of frequent words; with the frequent
    pairs ``known``, of the triples made of them."""
    size = len(known) + 2

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [k.value for k in known]
        codes, n = [np.zeros(0, np.int64)], 0
        for _, _, ids, own, seen in numbered(batches, frequent.value, bits, held, chunk):
            at = starts_of(ids.marked(own, maps)[-1], 2, seen - size + 2)
            codes.append(ids.codes_of(own, size)[at])
            n += len(at)
            if n > entries:
                yield from code_blocks(np.concatenate(codes), part_bits)
                codes, n = [np.zeros(0, np.int64)], 0
        yield from code_blocks(np.concatenate(codes), part_bits)

    return texts.mapInArrow(count, BLOCK)


def phrase_runs(
    texts: DataFrame,
    frequent: Broadcast,
    pairs: Broadcast | None = None,
    bits: int = FILTER_BITS,
    entries: int = TRIE_ENTRIES,
    held: int = HELD_WORDS,
    chunk: int = CHUNK_BYTES,
    triples: Broadcast | None = None,
) -> DataFrame:
    """Runs of subtrees: counts of the phrases of two words to ``LONGEST`` made of
    frequent ``pairs`` and, where given, ``triples``. Without either, the counts by
    code that tell which pairs are frequent."""
    if pairs is None:
        return code_runs(texts, frequent, (), bits, entries, held, chunk)
    known = [pairs] if triples is None else [pairs, triples]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [k.value for k in known]
        tries: dict[str, tuple[_Ids, HatTrie]] = {}
        last = 0

        def spilled(keep: int) -> Iterator[pa.RecordBatch]:
            for lang, (ids, trie) in tries.items():
                yield from sorted_run(lang, ids.words, trie.spill(keep))

        for era, lang, ids, own, seen in numbered(batches, frequent.value, bits, held, chunk):
            if era != last:
                yield from spilled(0)
                tries.clear()
                last = era
            _, trie = tries.setdefault(lang, (ids, HatTrie()))
            marks = ids.marked(own, maps)
            first, rest = [], []
            for size in range(2, LONGEST + 1):
                level = min(size, len(marks) + 1)
                at = starts_of(marks[level - 2], size - level + 2, seen - level + 2)
                packed = np.zeros(len(at), np.int64)
                for k in range(1, size):
                    packed |= own[at + k] << (3 - k) * _ID_BITS
                first.append(own[at])
                rest.append(packed)
            trie.add(np.concatenate(first), np.concatenate(rest))
            if sum(t.entries for _, t in tries.values()) > entries:
                yield from spilled(entries // 2 // len(tries))
        yield from spilled(0)

    return texts.mapInArrow(count, RUN)


def merged(runs: DataFrame, least: int) -> DataFrame:
    """Phrases of ``least`` occurrences or more, by partitions of prefixes."""
    prefix = F.hash("lang", F.substring_index("phrase", " ", 3))
    together = runs.withColumn("prefix", prefix).repartition("prefix")
    counts = together.groupBy("prefix", "lang", "phrase").agg(F.sum("f").alias("f"))
    return counts.where(F.col("f") >= least).select("lang", "phrase", "f")


@dataclass(frozen=True)
class Counts:
    """``words``: (lang, n) of all words; ``grams``: (lang, phrase, size, f) of
    the phrases of one word and more that occur often enough."""

    words: DataFrame
    grams: DataFrame


def phrase_counts(docs: DataFrame, text: str, lang: str, least: int) -> Counts:
    texts = texts_of(docs, text, lang)
    # Words are summed by themselves; a language may hold any share of them.
    every = written(word_runs(texts).groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "words")
    words = every.where(F.col("f") >= least)
    known = frequent_words(words)
    total = every.agg(F.sum("f")).first()[0] or 0
    part_bits = max(PART_BITS, (total // PART_WORDS).bit_length())
    pairs = frequent_pairs(code_runs(texts, known, part_bits=part_bits), least)
    triples = frequent_pairs(code_runs(texts, known, (pairs,), part_bits=part_bits), least)
    long = merged(phrase_runs(texts, known, pairs, triples=triples), least)
    size = (F.length(F.regexp_replace("phrase", "[^ ]", "")) + 1).alias("size")
    grams = words.unionByName(long).select("lang", "phrase", size, "f")
    return Counts(every.groupBy("lang").agg(F.sum("f").alias("n")), written(grams, "grams"))


def _exact(name: str) -> str:
    return f"CAST({name} AS DECIMAL(28, 0))"


def scored(grams: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of the phrases of two words and more,
    by the cut with the lowest score. Products are decimals of up to 38 digits."""
    table = measured(grams, ["lang", "phrase"])
    cuts = (
        table.df.where("size > 1")
        .select("*", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
        .withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("tail", F.expr("substring(phrase, length(head) + 2)"))
    )
    cuts = attach(
        cuts,
        Lookup(table, {"lang": "lang", "phrase": "head"}, {"f": "l"}),
        Lookup(table, {"lang": "lang", "phrase": "tail"}, {"f": "r"}),
    )
    score = F.expr(f"{SCALE} * {_exact('f')} DIV ({_exact('l')} + {_exact('r')})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    per_phrase = cuts.groupBy("lang", "phrase", "size", F.col("f").alias("a")).agg(lowest)
    return per_phrase.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def uncovered(candidates: DataFrame, percent: int = INSIDE_PERCENT) -> DataFrame:
    """Candidates without a longer one around them that is nearly as frequent."""
    inner = (
        candidates.where("size > 2")
        .select("lang", "a", "size", F.split("phrase", " ").alias("w"))
        .select("*", F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
        .select("*", F.explode(F.expr("sequence(1, size - m + 1)")).alias("at"))
        .select("lang", "a", F.expr("array_join(slice(w, at, m), ' ')").alias("phrase"))
    )
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    table = measured(around, ["lang", "phrase"])
    keys = {"lang": "lang", "phrase": "phrase"}
    out = attach(candidates, Lookup(table, keys, {"around": "around"}))
    covered = F.expr(f"100 * {_exact('around')} >= {percent} * {_exact('a')}")
    return out.where(F.col("around").isNull() | ~covered).drop("around")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    kept: int = KEPT,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``kept``
    phrases of two to four words by score, then occurrences, then bytes.

    A-Z count as a-z. Occurrences overlap and stay within pieces, the parts of a
    text between ``.,;:!?`` and line ends. Phrases of fewer than ``least``
    occurrences are no candidates. A null language is ``und``, together with
    texts that say so; null and empty texts have no words; rows that repeat count
    each; no rows, or none often enough, give no rows. Other columns are ignored.
    Texts of any length are read in chunks, in which nothing is cut apart.
    """
    counts = phrase_counts(docs, text, lang, least)
    found = uncovered(written(scored(counts.grams), "scored"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= kept)
    # At most ``kept`` rows of a language meet its number of words.
    return ranked.join(counts.words, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = rf"""
WITH d AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                              '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), p AS (
  SELECT lang, row_number() OVER () AS piece_no,
    list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM d
), places AS (
  SELECT lang, piece_no, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM p
), ahead AS (
  SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
  FROM places WINDOW o AS (PARTITION BY piece_no ORDER BY i)
), g AS (
  SELECT lang, 1 AS size, w1 AS phrase, count(*) AS f FROM ahead GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM ahead
  WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM ahead
  WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM ahead
  WHERE w4 IS NOT NULL GROUP BY ALL
), words AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE size = 1 GROUP BY lang
), often AS (
  SELECT *, string_split(phrase, ' ') AS w FROM g WHERE f >= {LEAST}
), cuts AS (
  SELECT c.lang, c.phrase, c.size, c.w, c.f AS a, k, h.f AS l, t.f AS r,
    CAST({SCALE}::HUGEINT * c.f // (h.f + t.f) AS BIGINT) AS score
  FROM (SELECT *, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
        FROM (SELECT *, unnest(range(1, size)) AS k FROM often)) c
  JOIN often h ON h.lang = c.lang AND h.phrase = head
  JOIN often t ON t.lang = c.lang AND t.phrase = tail
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_parts AS (
  SELECT lang, a, w, m, unnest(range(1, size - m + 2)) AS i
  FROM (SELECT *, unnest(range(2, size)) AS m FROM lowest)
), around AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS f
  FROM inner_parts GROUP BY ALL
), ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) AS rank
  FROM lowest c LEFT JOIN around o ON o.lang = c.lang AND o.phrase = c.phrase
  WHERE o.f IS NULL OR 100::HUGEINT * o.f < {INSIDE_PERCENT}::HUGEINT * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN words USING (lang) WHERE rank <= {KEPT}
"""


@registered("op11_collocations", ORACLE)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))
