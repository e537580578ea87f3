"""Words of Arrow texts as 64-bit hashes, a whole batch at a time.

A word is a run of bytes that are ASCII digits, ASCII letters (A-Z count as
a-z) or parts of non-ASCII characters; that is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
after lower-casing A-Z. Everything is computed over the UTF-8 bytes with numpy;
no Python object is made for a word.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _lower_table() -> np.ndarray:
    """Byte to its lower-case form, 0 for bytes outside of words."""
    table = np.zeros(256, np.uint8)
    table[48:58] = np.arange(48, 58)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


LOWER = _lower_table()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    out = np.multiply.accumulate(steps)
    out.flags.writeable = False
    return out


@lru_cache(maxsize=2)
def _kept_powers(base: np.uint64, n: int) -> np.ndarray:
    return _powers(base, n)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers, modulo 2**64, not to be written to. Those of the texts
    of a slice are computed once for all slices; they take 8 MB for each base."""
    kept = CHUNK_BYTES + 1
    return _powers(base, n) if n > kept else _kept_powers(base, kept)[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each text starts (one entry more
    than texts); null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


@dataclass(frozen=True)
class Words:
    """``hashes`` of all words, text by text; text i has those from
    ``offsets[i]`` to ``offsets[i + 1]``. ``lengths`` are in bytes. ``prefixes``
    has hashes of the words' first bytes, 0 for words with no more than those."""

    hashes: np.ndarray
    offsets: np.ndarray
    lengths: np.ndarray
    prefixes: tuple[np.ndarray, ...] = ()

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut where texts meet."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    first[edges] |= inside[edges]
    last[edges - 1] |= inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def power(base: np.uint64, exponents: np.ndarray) -> np.ndarray:
    """``base`` to each exponent, modulo 2**64."""
    left, step = exponents.astype(np.uint64), np.full(1, base, np.uint64)
    out = np.ones(len(left), np.uint64)
    while left.any():
        out = np.where(left & np.uint64(1), out * step, out)
        left, step = left >> np.uint64(1), step * step
    return out


def running_sums(values: np.ndarray) -> np.ndarray:
    """Sums of the byte values before each place, each by a power of its place."""
    run = np.empty(len(values) + 1, np.uint64)
    run[0] = 0
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(values)), out=run[1:])
    return run


def hash_spans(values: np.ndarray, starts: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
    """A 64-bit hash of each span of byte values, by one running sum; one array
    for each array of ends."""
    run = running_sums(values)
    back, before = powers(_INVERSE, len(values) + 1)[starts], run[starts]
    return [mix((run[e] - before) * back) for e in ends]


def cuts(outside: np.ndarray, data: np.ndarray, size: int) -> list[int]:
    """Places to cut ``data`` into parts of about ``size`` bytes, each before a byte
    that ``outside`` holds for; a stretch without one stays whole."""
    out = [0]
    while len(data) - out[-1] > size:
        at = out[-1] + size
        while at < len(data):
            window = outside[data[at : at + size]]
            step = int(window.argmax())
            if window[step]:
                break
            at += len(window)
        if at >= len(data):
            break
        out.append(at + step)
    return [*out, len(data)]


def batch_words(
    column: pa.Array, prefixes: tuple[int, ...] = (), chunk: int = CHUNK_BYTES
) -> Words:
    """The words of all texts. The arrays it works on take many times the bytes
    they are made of, so a long text is gone through in chunks between words."""
    data, offsets = text_bytes(column)
    places = cuts(LOWER == 0, data, chunk)
    parts = []
    for a, b in zip(places[:-1], places[1:]):
        values = LOWER[data[a:b]]
        starts, ends = spans(values != 0, offsets - a)
        lengths = ends - starts
        hashes = hash_spans(values, starts, ends, *[np.minimum(ends, starts + p) for p in prefixes])
        heads = (
            np.where(lengths > p, mix(h + np.uint64(p)), np.uint64(0))
            for p, h in zip(prefixes, hashes[1:])
        )
        parts.append((hashes[0], starts + a, lengths, *heads))
    hashes, starts, lengths, *heads = map(np.concatenate, zip(*parts))
    return Words(hashes, np.searchsorted(starts, offsets), lengths, tuple(heads))


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words and the offsets by text. A text of
    fewer words has one run, of all its words; one without words has none."""
    counts = np.diff(words.offsets)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(runs)])
    first = np.repeat(words.offsets[:-1] - offsets[:-1], runs) + np.arange(offsets[-1])
    end = np.repeat(words.offsets[1:], runs)
    out = np.zeros(offsets[-1], np.uint64)
    for k in range(width):
        at = first + k
        there = at < end
        part = np.where(there, words.hashes[np.minimum(at, max(0, len(words.hashes) - 1))], 0)
        out = mix(out * _BASE + part.astype(np.uint64) + np.uint64(k + 1))
    return out, offsets


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
