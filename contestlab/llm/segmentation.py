"""Distinct sampled segmentations: Gumbel top-k over the lattice of a text.

The pieces of a public vocabulary span a lattice over a text. A piece of rank r
weighs 1 / (r + 10), scaled to sum to one over the vocabulary (the file's scores
are merge ranks); a character that is no piece is spelled in byte pieces. Sums
of weights from the end give every arc its probability, so a path of arcs is a
segmentation with the probability of its weight.

Perturbed A* search without replacement: give every segmentation its log
probability plus independent Gumbel noise, and the k largest are k samples
without replacement. The noise is drawn from the top: a set of paths with a
common beginning has a Gumbel value whose location is the log of its
probability - the exact heuristic - and the largest of its parts inherits it,
the others get Gumbel values cut off there. The search pops the set with the
largest value, completes its best path by sampling, and queues, for every unit
of the text behind the branch, the set of paths that first differ in that unit.

No piece crosses from another character to a space or stands on both sides of a
line end, so a text is a chain of units (spaces and what follows them, line
ends), each with a lattice of its own. The lattices of all distinct units of a
batch are built and sampled together with numpy; a text of n units takes
O(n) per sample.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from contestlab.llm.registry import registered
from contestlab.llm.tables import bounded_batches, quoted, read, slices, with_fields
from contestlab.llm.token_counts import vocabulary_path
from contestlab.llm.words import _BASE, _INVERSE, hash_spans, mix, powers, text_bytes, uniform

SAMPLES = 2
SEED = 7
SLICE_BYTES = 1 << 19
LATTICE_BYTES = 60_000  # of units whose nodes mostly have 16-bit numbers, which sort fastest
KEPT_BYTES = 3 << 19
RANK_SHIFT = 10.0
MARK = "▁"
_SLOT_BITS = 20
LEAST = 1e-5  # probabilities of a unit's paths add up to one but for about this


@dataclass
class Vocabulary:
    """Pieces by hash of their bytes (the mark is a space), their log weights,
    and what each id decodes to."""

    longest: int
    hashes: np.ndarray
    ids: np.ndarray
    weights: np.ndarray
    slots: tuple[np.ndarray, np.ndarray]
    beginnings: np.ndarray
    byte_ids: np.ndarray
    byte_weight: float
    decoded: np.ndarray
    starts: np.ndarray

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        spelled, ids, byte_ids = [], [], np.zeros(256, np.int32)
        decoded = [b""] * model.get_piece_size()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                decoded[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                spelled.append(piece.replace(MARK, " ").encode())
                ids.append(i)
                decoded[i] = spelled[-1]
        lengths = np.array([len(p) for p in spelled])
        ends = np.cumsum(lengths)
        hashes = hash_spans(np.frombuffer(b"".join(spelled), np.uint8), ends - lengths, ends)[0]
        weights = 1.0 / (np.arange(len(ids)) + RANK_SHIFT)
        total = weights.sum()
        # Two tables of slots: the second for pieces whose slot in the first is taken.
        slots = []
        left = np.arange(len(ids))
        for shift in (0, _SLOT_BITS):
            at = (hashes[left] >> np.uint64(shift)) & np.uint64((1 << _SLOT_BITS) - 1)
            table = np.full(1 << _SLOT_BITS, -1, np.int32)
            table[at] = left
            slots.append(table)
            left = left[table[at] != left]
        if len(left):
            raise ValueError("pieces without a slot")
        # Which hashes may be those of a piece's beginning; a wrong yes costs time only.
        flat = np.frombuffer(b"".join(spelled), np.uint8)
        firsts = np.repeat(ends - lengths, lengths)
        begun = hash_spans(flat, firsts, np.arange(1, len(flat) + 1))[0]
        beginnings = np.zeros(1 << _SLOT_BITS, bool)
        beginnings[begun & np.uint64((1 << _SLOT_BITS) - 1)] = True
        return cls(
            int(lengths.max()),
            hashes,
            np.array(ids, np.int32),
            np.log(weights / total).astype(np.float32),
            (slots[0], slots[1]),
            beginnings,
            byte_ids,
            float(-np.log(total * (len(ids) + RANK_SHIFT))),
            np.frombuffer(b"".join(decoded), np.uint8),
            np.concatenate([[0], np.cumsum([len(d) for d in decoded])]),
        )

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The pieces with these hashes, -1 where there is none."""
        mask = np.uint64((1 << _SLOT_BITS) - 1)
        out = self.slots[0][hashes & mask]
        out[self.hashes[out] != hashes] = -1
        none = np.flatnonzero(out < 0)
        second = self.slots[1][(hashes[none] >> np.uint64(_SLOT_BITS)) & mask]
        out[none] = np.where(self.hashes[second] == hashes[none], second, -1)
        return out

    def begins(self, hashes: np.ndarray) -> np.ndarray:
        return self.beginnings[hashes & np.uint64((1 << _SLOT_BITS) - 1)]

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the ids stand for."""
        return self.decoded[spans(self.starts[ids], self.lengths[ids])]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text that the ids stand for, without the space put before it."""
        return self.spelled(ids).tobytes()[1:]


def char_lengths(data: np.ndarray) -> np.ndarray:
    """Bytes of the character that begins at each byte, 0 inside of one."""
    out = np.ones(len(data), np.int64)
    out[data >= 0xC0] = 2
    out[data >= 0xE0] = 3
    out[data >= 0xF0] = 4
    out[(data >= 0x80) & (data < 0xC0)] = 0
    return out


@dataclass
class Paths:
    """Arcs (node in bytes from the unit's start, length, piece or -1 for a
    spelled character) of one path per unit, and its log probability."""

    offsets: np.ndarray
    at: np.ndarray
    length: np.ndarray
    piece: np.ndarray
    log_prob: np.ndarray


class Lattice:
    """The lattices of some units, each a span of ``data``: by node its first arc and how
    many, by arc its length, log probability, piece, and the probability of the node's arcs
    before it."""

    def __init__(self, vocabulary: Vocabulary, data: np.ndarray, lengths: np.ndarray):
        self.starts = np.cumsum(lengths) - lengths
        self.ends = self.starts + lengths
        n = len(data)
        remaining = np.repeat(self.ends, lengths) - np.arange(n)
        chars = char_lengths(data)
        run = np.empty(n + 1, np.uint64)
        run[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=run[1:])
        back = powers(_INVERSE, n + 1)
        heads = np.flatnonzero(chars > 0)
        begins, arcs = heads, []
        whole = np.zeros(n, bool)  # characters that are pieces
        # An arc ends where a character ends; pieces are whole characters.
        for length in range(1, vocabulary.longest + 1):
            begins = begins[remaining[begins] >= length]
            hashes = mix((run[begins + length] - run[begins]) * back[begins])
            on = vocabulary.begins(hashes)
            begins = begins[on]
            if not len(begins):
                break
            found = vocabulary.find(hashes[on])
            hit = found >= 0
            nodes = begins[hit]
            whole[nodes] |= chars[nodes] == length
            arcs.append((nodes, np.full(len(nodes), length), found[hit]))
        spelled = heads[~whole[heads]]
        arcs.append((spelled, chars[spelled], np.full(len(spelled), -1, np.int32)))

        # Nodes by their distance from the unit's end, the arcs of a node together.
        small = np.min_scalar_type(int(lengths.max()))
        order = heads[np.argsort(remaining[heads].astype(small), kind="stable")]
        rank = np.zeros(n, np.min_scalar_type(n))
        rank[order] = np.arange(len(order))
        nodes, length, piece = (np.concatenate(column) for column in zip(*arcs))
        own = rank[nodes]
        counts = np.bincount(own, minlength=len(order))
        first = np.concatenate([[0], np.cumsum(counts)])
        by_node = np.argsort(own, kind="stable")
        nodes, length, self.piece = nodes[by_node], length[by_node], piece[by_node]
        # The unit's end is not the next one's start.
        target = np.where(remaining[nodes] == length, n, nodes + length)
        weight = np.where(
            self.piece < 0, length * vocabulary.byte_weight, vocabulary.weights[self.piece]
        )
        self.log_prob = weight.astype(np.float32)
        self.length = length.astype(np.int16)
        self.first, self.count = np.zeros(n, np.int32), np.zeros(n, np.int16)
        self.first[order], self.count[order] = first[:-1], counts

        # Sums from the ends of the units, all nodes at the same distance at once.
        behind = np.full(n + 1, -np.inf, np.float32)
        behind[n] = 0
        cuts = np.flatnonzero(np.diff(remaining[order])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(order)]):
            i, j = first[a], first[b]
            if i == j:
                continue
            scores = self.log_prob[i:j] + behind[target[i:j]]
            heads = first[a:b] - i
            top = np.maximum.reduceat(scores, heads)
            parts = np.exp(scores - np.repeat(top, counts[a:b]))
            top += np.log(np.add.reduceat(parts, heads))
            behind[order[a:b]] = top
            self.log_prob[i:j] = scores - np.repeat(top, counts[a:b])
        share = np.exp(self.log_prob.astype(np.float64))
        before = np.cumsum(share) - share
        self.below = (before - np.repeat(before[first[:-1]], counts)).astype(np.float32)

    def step(self, nodes: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The length, log probability and piece of an arc per node, by its probability."""
        arc = self.first[nodes] + self.count[nodes] - 1
        above = np.flatnonzero(self.below[arc] > u)
        while len(above):
            arc[above] -= 1
            above = above[self.below[arc[above]] > u[above]]
        return self.length[arc], self.log_prob[arc], self.piece[arc]

    def arc(self, nodes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The arcs of these lengths, one per node."""
        arc = self.first[nodes]
        other = np.flatnonzero(self.length[arc] != lengths)
        while len(other):
            arc[other] += 1
            other = other[self.length[arc[other]] != lengths[other]]
        return arc

    def rows(self, nodes: np.ndarray, width: int) -> np.ndarray:
        """Log probabilities by node and arc length - 1."""
        out = np.full((len(nodes), width), -np.inf)
        counts = self.count[nodes].astype(np.int64)
        arcs = spans(self.first[nodes], counts)
        out[np.repeat(np.arange(len(nodes)), counts), self.length[arcs] - 1] = self.log_prob[arcs]
        return out

    def sample(
        self, units: np.ndarray, seeds: np.ndarray, begin: np.ndarray | None = None
    ) -> Paths:
        """One path per unit (from node ``begin`` on)."""
        starts = self.starts[units]
        return walked(starts, starts if begin is None else begin, self.ends[units], seeds, self.step)

    def differing(
        self, units: np.ndarray, paths: list[list[tuple]], seeds: np.ndarray
    ) -> list[tuple | None]:
        """For each unit a path that is none of its given ones, by its probability
        among all others; None where there is no other."""
        several = [i for i, own in enumerate(paths) if len(own) > 1]
        single = [i for i, own in enumerate(paths) if len(own) == 1]
        out: list[tuple | None] = [None] * len(paths)
        if single:
            found = self.differing_from_one(units[single], [paths[i][0] for i in single], seeds[single])
            for i, arcs in zip(single, found):
                if np.array_equal(arcs[1], paths[i][0][1]):  # rounding, or no other path
                    several.append(i)
                else:
                    out[i] = arcs
        for i in several:
            out[i] = self.differing_from_all(units[i : i + 1], paths[i], seeds[i : i + 1])
        return out

    def differing_from_all(self, unit: np.ndarray, paths: list[tuple], seed: np.ndarray) -> tuple | None:
        """A path of one unit that is none of several: by the arcs at which it may
        leave all of them, which are those out of the nodes of their prefix tree
        that none of them takes. Their masses are sums of what is left, not
        differences, so a small mass is as exact as a large one."""
        start = int(self.starts[unit[0]])
        width = int(self.length.max())
        leaves: dict[tuple, np.ndarray] = {}
        before: dict[tuple, float] = {}
        for at, length, _, _ in paths:
            log_prob, prefix = 0.0, ()
            for node, step in zip((at + start).tolist(), length.tolist()):
                if prefix not in leaves:
                    leaves[prefix] = np.exp(self.rows(np.array([node]), width)[0])
                    before[prefix] = log_prob
                leaves[prefix][step - 1] = 0
                log_prob += float(self.log_prob[self.arc(np.array([node]), np.array([step]))[0]])
                prefix = (*prefix, step)
        names = list(leaves)
        mass = np.concatenate([np.exp(before[name]) * leaves[name] for name in names])
        run = np.cumsum(mass)
        if not run[-1] > 0:
            return None
        at = int(np.searchsorted(run, float(uniform(mix(seed + np.uint64(1)))[0]) * run[-1], "right"))
        at = min(at, int(np.flatnonzero(mass)[-1]))
        prefix, column = names[at // width], at % width
        length = np.array([*prefix, column + 1], np.int16)
        place = np.concatenate([[0], np.cumsum(length[:-1], dtype=np.int64)]).astype(np.int64)
        end = start + int(place[-1]) + column + 1
        free = self.sample(unit, seed + np.uint64(3), np.array([end]))
        arcs = self.arc(start + place, length)
        log_prob = before[prefix] + float(self.log_prob[arcs[-1]])
        return (
            np.concatenate([place, free.at]),
            np.concatenate([length, free.length]),
            np.concatenate([self.piece[arcs], free.piece]),
            log_prob + float(free.log_prob[0]),
        )

    def differing_from_one(
        self, units: np.ndarray, paths: list[tuple], seeds: np.ndarray
    ) -> list[tuple]:
        """For each unit a path that is not its given one, by its probability
        among all others: first where it leaves that path, then how, then freely."""
        counts = np.array([len(p[0]) for p in paths])
        offsets = np.concatenate([[0], np.cumsum(counts)])
        at = np.concatenate([p[0] for p in paths])
        length = np.concatenate([p[1] for p in paths])
        nodes = np.repeat(self.starts[units], counts) + at
        own = self.arc(nodes, length)
        taken, piece = self.log_prob[own].astype(np.float64), self.piece[own]
        before = np.cumsum(taken) - taken
        before -= np.repeat(before[offsets[:-1]], counts)
        others = np.exp(self.rows(nodes, int(self.length.max())))
        others[np.arange(len(nodes)), length - 1] = 0
        leave = np.exp(before) * others.sum(axis=1)
        run = np.concatenate([[0.0], np.cumsum(leave)])
        low, high = run[offsets[:-1]], run[offsets[1:]]
        u = [uniform(mix(seeds + np.uint64(k))) for k in (1, 2)]
        step = np.searchsorted(run, low + u[0] * (high - low), "right") - 1
        step = np.clip(step, offsets[:-1], offsets[1:] - 1)
        # Rounding may land on a step without another arc; the likeliest leave has one.
        for i in np.flatnonzero(leave[step] <= 0):
            own = slice(offsets[i], offsets[i + 1])
            step[i] = offsets[i] + int(np.argmax(leave[own]))
        rows = np.cumsum(others[step], axis=1)
        column = (rows < (u[1] * rows[:, -1])[:, None]).sum(axis=1)
        free = self.sample(units, seeds + np.uint64(3), nodes[step] + column + 1)
        turn = self.arc(nodes[step], column + 1)
        log_prob = before[step] + self.log_prob[turn] + free.log_prob
        out = []
        for i, s in enumerate(step.tolist()):
            kept = slice(offsets[i], s)
            own = slice(free.offsets[i], free.offsets[i + 1])
            c = int(column[i])
            out.append(
                (
                    np.concatenate([at[kept], at[s : s + 1], free.at[own]]),
                    np.append(np.append(length[kept], np.int16(c + 1)), free.length[own]),
                    np.concatenate(
                        [
                            piece[kept],
                            self.piece[turn[i : i + 1]],
                            free.piece[own],
                        ]
                    ),
                    float(log_prob[i]),
                )
            )
        return out


def walked(starts, begin, ends, seeds, step) -> Paths:
    """One path per unit from node ``begin`` to its end by ``step``; draw s of a
    path comes from its seed and s."""
    here = begin.copy()
    log_prob = np.zeros(len(here))
    active = np.flatnonzero(here < ends)
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    while len(active):
        nodes = here[active]
        u = uniform(mix(seeds[active] + np.uint64(len(steps) + 1)))
        length, gained, piece = step(nodes, u)
        log_prob[active] += gained
        steps.append((active, nodes, length, piece))
        nodes = nodes + length
        here[active] = nodes
        active = active[nodes < ends[active]]
    counts = np.zeros(len(here), np.int64)
    for own, *_ in steps:
        counts[own] += 1
    offsets = np.concatenate([[0], np.cumsum(counts)])
    at = np.zeros(offsets[-1], np.int64)
    length = np.zeros(offsets[-1], np.int16)
    piece = np.zeros(offsets[-1], np.int32)
    for s, (own, nodes, lengths, pieces) in enumerate(steps):
        place = offsets[own] + s
        at[place] = nodes - starts[own]
        length[place] = lengths
        piece[place] = pieces
    return Paths(offsets, at, length, piece, log_prob)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the spans, one span behind the other; in 32 bits if they fit."""
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(ends) else 0
    shifts = starts - (ends - lengths)
    small = n < 1 << 30 and (not n or int(starts.max()) < 1 << 30)
    kind = np.int32 if small else np.int64
    out = np.repeat(shifts.astype(kind), lengths)
    out += np.arange(n, dtype=kind)
    return out


# An arc in 16 bytes, so that a step reads one place of memory; moved as a number.
_ARC = np.dtype([("below", "f4"), ("log_prob", "f4"), ("piece", "i4"), ("length", "i2"), ("", "i2")])
_MOVED = np.complex128


def _lots(sizes: np.ndarray) -> list[np.ndarray]:
    """The places of units that stand one behind the other, some at a time."""
    if not len(sizes):
        return []
    lots = (np.cumsum(sizes) - sizes) // LATTICE_BYTES
    return np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(lots)) + 1)


class Kept:
    """Lattices of units by hash. Nodes and arcs stand in the order of the units' places."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.first, self.count = np.zeros(0, np.int32), np.zeros(0, np.int16)
        self.arcs = np.zeros(0, _MOVED)
        self.hashes = np.zeros(0, np.uint64)  # sorted, as are the columns that go with them
        self.heads, self.sizes, self.seen = (np.zeros(0, np.int64) for _ in range(3))
        self.room: dict[str, np.ndarray] = {}  # what the columns of nodes and arcs lie in

    def step(self, nodes: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The length, log probability and piece of an arc per node, by its probability."""
        arc = self.first[nodes] + self.count[nodes] - 1
        moved = self.arcs[arc]
        own = moved.view(_ARC)
        above = np.flatnonzero(own["below"] > u)
        while len(above):
            arc[above] -= 1
            moved[above] = self.arcs[arc[above]]
            above = above[own["below"][above] > u[above]]
        return own["length"], own["log_prob"], own["piece"]

    def extend(self, name: str, part: np.ndarray) -> None:
        """Put ``part`` behind a column, in its room where that is large enough."""
        own = getattr(self, name)
        n, size = len(own), len(own) + len(part)
        room = self.room.get(name)
        if room is None or len(room) < size:
            room = self.room[name] = np.empty(size + size // 2, own.dtype)
            room[:n] = own
        room[n:size] = part
        setattr(self, name, room[:size])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Where these hashes are, -1 for those that are not."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def add(self, hashes: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> None:
        """Lattices of further units, built some at a time."""
        starts = np.cumsum(sizes) - sizes
        heads = len(self.first) + starts
        for own in _lots(sizes):
            begin, end = starts[own[0]], starts[own[-1]] + sizes[own[-1]]
            lattice = Lattice(self.vocabulary, data[begin:end], sizes[own])
            # Arcs in the order of their nodes, so that ``trim`` can move both forward.
            counts = lattice.count.astype(np.int64)
            arcs = spans(lattice.first, counts)
            packed = np.zeros(len(arcs), _ARC)
            for name in ("below", "log_prob", "piece", "length"):
                packed[name] = getattr(lattice, name)[arcs]
            self.extend("first", (len(self.arcs) + np.cumsum(counts) - counts).astype(np.int32))
            self.extend("count", lattice.count)
            self.extend("arcs", packed.view(_MOVED))
        hashes = np.concatenate([self.hashes, hashes])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.heads = np.concatenate([self.heads, heads])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]
        self.seen = np.concatenate([self.seen, np.zeros(len(sizes), np.int64)])[order]

    def trim(self, limit: int) -> None:
        """Above one and a half ``limit`` bytes of units, keep the most frequent within it."""
        if 2 * len(self.first) <= 3 * limit:
            return
        order = np.argsort(-self.seen, kind="stable")
        rows = np.sort(order[np.cumsum(self.sizes[order]) <= limit])
        # By place, so that units move forward only: some at a time, nothing is held twice.
        place = np.argsort(self.heads[rows], kind="stable")
        heads, sizes = self.heads[rows[place]], self.sizes[rows[place]]
        n = m = 0
        for own in _lots(sizes):
            nodes = spans(heads[own], sizes[own])
            counts = self.count[nodes].astype(np.int64)
            arcs = self.arcs[spans(self.first[nodes], counts)]
            end = n + len(nodes)
            self.count[n:end] = counts
            self.first[n:end] = m + np.cumsum(counts) - counts
            self.arcs[m : m + len(arcs)] = arcs
            n, m = end, m + len(arcs)
        self.first, self.count, self.arcs = self.first[:n], self.count[:n], self.arcs[:m]
        self.hashes, self.sizes, self.seen = self.hashes[rows], self.sizes[rows], self.seen[rows]
        self.heads = np.empty(len(rows), np.int64)
        self.heads[place] = np.cumsum(sizes) - sizes

    def sample(self, units: np.ndarray, seeds: np.ndarray) -> Paths:
        starts = self.heads[units]
        return walked(starts, starts, starts + self.sizes[units], seeds, self.step)


def unit_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the units of all texts, and the offsets of the texts in them."""
    n = len(data)
    first = np.zeros(n, bool)
    before = np.concatenate([[10], data[:-1]]) if n else data
    first |= (data == 32) & (before != 32)
    first |= (data == 10) | (before == 10)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(first)
    return starts, np.searchsorted(starts, offsets)


def cut_gumbel(location: np.ndarray, limit, u: np.ndarray) -> np.ndarray:
    """Gumbel values of these locations, given that they are below the limit."""
    with np.errstate(divide="ignore"):
        noise = np.log(-np.log(u))
        return -np.logaddexp(-limit, noise - location)


@dataclass
class Units:
    """The units of some texts: spans of ``data``, one behind the other, and their seeds;
    the hashes of the distinct ones, one unit of each, and which of them a unit is."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    seeds: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    kind: np.ndarray

    def bytes_of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.ends[units] - self.starts[units]
        if len(units) == len(self.starts) and (units == np.arange(len(units))).all():
            return self.data, lengths
        return gathered(self.data, self.starts[units], lengths)


@dataclass
class Draw:
    """One path each of some units, the ids by unit, and which units decode to
    their bytes."""

    paths: Paths
    ids: np.ndarray
    offsets: np.ndarray
    right: np.ndarray


class Sampler:
    def __init__(self, vocabulary: Vocabulary, samples: int, seed: int, kept_bytes: int | None = None):
        self.vocabulary, self.samples, self.seed = vocabulary, samples, seed
        self.kept_bytes = KEPT_BYTES if kept_bytes is None else kept_bytes
        self.kept = Kept(vocabulary)

    def draw(self, all_: Units, units: np.ndarray, sample: int) -> Draw:
        """An independent path for each of these units, from its seed. The lattices
        of distinct units are taken from those kept or built, some at a time."""
        seeds = mix(all_.seeds[units] + np.uint64((sample + 1) << 12))
        kind = all_.kind[units]
        seen = np.bincount(kind, minlength=len(all_.hashes))
        there = seen > 0
        names, first, seen = all_.hashes[there], all_.first[there], seen[there]
        kind = (np.cumsum(there) - 1)[kind]
        group = (np.cumsum(all_.ends[first] - all_.starts[first]) - 1) // (self.kept_bytes // 2)
        members, parts = [], []
        for g in range(int(group[-1]) + 1 if len(group) else 0):
            kinds = np.flatnonzero(group == g)
            if not len(kinds):
                continue
            new = kinds[self.kept.find(names[kinds]) < 0]
            if len(new):
                self.kept.add(names[new], *all_.bytes_of(first[new]))
            rows = self.kept.find(names[kinds])
            self.kept.seen[rows] += seen[kinds]
            own = np.flatnonzero(group[kind] == g)
            members.append(own)
            parts.append(self.kept.sample(rows[kind[own] - kinds[0]], seeds[own]))
            self.kept.trim(self.kept_bytes)
        paths = parts[0] if len(parts) == 1 else in_order(members, parts, len(units))
        return self.spelled(paths, all_, units)

    def run(self, texts: list[str], keys: list) -> list[list[tuple]]:
        """For each text, its samples (ids, log probability, Gumbel value,
        inclusion score, whether decoding gives the text), largest value first;
        none for an empty text."""
        column = pa.array([f" {t.replace(MARK, ' ')}" if t else "" for t in texts], pa.large_string())
        data, offsets = text_bytes(column)
        starts, bounds = unit_spans(data, offsets)
        ends = np.append(starts[1:], len(data))
        row_seeds = np.array([row_seed(k, self.seed) for k in keys], np.uint64)
        counts = np.diff(bounds)
        if not len(starts):
            return [[] for _ in texts]
        place = np.arange(len(starts)) - np.repeat(bounds[:-1], counts)
        seeds = mix(np.repeat(row_seeds, counts) + (place.astype(np.uint64) << np.uint64(16)))
        hashes = hash_spans(data, starts, ends)[0]
        distinct = np.unique(hashes, return_index=True, return_inverse=True)
        units = Units(data, starts, ends, seeds, *distinct)
        draw = self.draw(units, np.arange(len(starts)), 0)
        first = cut_values(draw.paths.log_prob, bounds, row_seeds, seeds)
        searches = {
            i: _Search(i, bounds, draw, first, seeds, self.samples)
            for i in np.flatnonzero(counts).tolist()
        }
        for sample in range(1, self.samples):
            open_ = list(searches.values())
            # A set that turns out to hold no other path is dropped for the next one.
            while popped := [(s, *best) for s in open_ if (best := s.pop()) is not None]:
                open_ = self.branch(popped, sample, units, row_seeds)
        out: list[list[tuple]] = [[] for _ in texts]
        for i, search in searches.items():
            out[i] = search.results()
        return out

    def spelled(self, paths: Paths, all_: Units, units: np.ndarray) -> Draw:
        own, lengths = all_.bytes_of(units)
        begins = np.cumsum(lengths) - lengths
        counts = np.diff(paths.offsets)
        ids, counts = self.ids(paths.at + np.repeat(begins, counts), paths.length, paths.piece, own)
        per_arc = np.concatenate([[0], np.cumsum(counts)])
        again = self.vocabulary.spelled(ids)
        right = np.zeros(len(units), bool)
        if len(again) == len(own):
            right[:] = True
            right[np.searchsorted(begins, np.flatnonzero(again != own), "right") - 1] = False
        return Draw(paths, ids, per_arc[paths.offsets], right)

    def ids(self, at, length, piece, data) -> tuple[np.ndarray, np.ndarray]:
        """Ids of arcs, and how many each has; ``at`` is the arc's first byte."""
        spelled = piece < 0
        ids = self.vocabulary.ids[piece]
        counts = np.where(spelled, length, 1).astype(np.int64)
        if not spelled.any():
            return ids, counts
        out = np.repeat(ids, counts)
        byte_at = np.repeat(at - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        of_byte = np.repeat(spelled, counts)
        out[of_byte] = self.vocabulary.byte_ids[data[byte_at[of_byte]]]
        return out, counts

    def branch(self, popped: list[tuple], sample: int, all_: Units, row_seeds) -> list:
        """Complete the best path of every popped set: a unit that differs from
        all paths gone before, then draws of the units behind it. Returns the
        searches whose set has no other path."""
        units = np.array([s.base + unit for s, _, _, unit in popped])
        lattice = Lattice(self.vocabulary, *all_.bytes_of(units))
        seeds = mix(row_seeds[[s.i for s, *_ in popped]] + np.uint64(sample << 40))
        gone = [s.gone(parent, unit) for s, _, parent, unit in popped]
        found = lattice.differing(np.arange(len(popped)), gone, mix(seeds))
        left = np.array([s.n - unit - 1 for s, _, _, unit in popped])
        left[[arcs is None for arcs in found]] = 0
        draw = self.draw(all_, spans(units + 1, left), sample) if left.any() else None
        row = np.cumsum(left) - left
        empty = []
        for w, arcs in enumerate(found):
            search, value, parent, unit = popped[w]
            if arcs is None:
                empty.append(search)
                continue
            begin, end = all_.starts[units[w]], all_.ends[units[w]]
            ids, _ = self.ids(arcs[0] + begin, arcs[1], arcs[2], all_.data)
            right = np.array_equal(self.vocabulary.spelled(ids), all_.data[begin:end])
            behind = (draw, int(row[w]) - unit - 1)
            search.add(value, parent, unit, arcs, ids, right, gone[w], behind)
        return empty


def left_over(log_prob: np.ndarray) -> np.ndarray:
    """The log probability of all other paths of units; none below LEAST, where
    single precision ends."""
    rest = -np.expm1(np.minimum(log_prob, 0))
    with np.errstate(divide="ignore"):
        return np.where(rest > LEAST, np.log(np.maximum(rest, 1e-300)), -np.inf)


def root_values(row_seeds: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(uniform(mix(row_seeds))))


def cut_values(
    log_prob: np.ndarray, bounds: np.ndarray, row_seeds: np.ndarray, seeds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Gumbel values of the first samples, and of the sets that first differ
    from them in each unit."""
    counts = np.diff(bounds)
    values = root_values(row_seeds)
    before = np.cumsum(log_prob) - log_prob
    before -= np.repeat(before[np.minimum(bounds[:-1], len(before) - 1)], counts)
    limits = np.repeat(values, counts)
    return values, cut_gumbel(before + left_over(log_prob), limits, uniform(mix(seeds + np.uint64(7))))


class _Search:
    """The search in one text: its samples so far, and the queue of sets of
    paths, each by its Gumbel value, the sample it branches from and the unit."""

    def __init__(self, i, bounds, draw, first, seeds, samples):
        self.i, self.base, self.n = i, int(bounds[i]), int(bounds[i + 1] - bounds[i])
        own = slice(self.base, self.base + self.n)
        # A draw for each sample, and what is to be added to a unit to get its row there.
        self.draws, self.samples = [(draw, self.base)], samples
        self.seeds = seeds[own]
        self.values = [float(first[0][i])]
        self.log_probs = [draw.paths.log_prob[own]]
        # A path is a list of (draw, first unit, last unit + 1), or (ids, arcs, ...) for one unit.
        self.paths: list[list] = [[(0, 0, self.n)]]
        self.sets: dict[tuple, list] = {}
        self.queue: list[tuple[float, int, int]] = []
        self.enqueue(first[1][own], 0, 0)

    def enqueue(self, values: np.ndarray, sample: int, begin: int) -> None:
        # More sets than samples are never popped, but for the last, whose value counts.
        some = min(self.samples, len(values))
        best = np.argpartition(-values, some - 1)[:some] if some else []
        self.queue.extend((float(values[b]), sample, begin + int(b)) for b in best)

    def pop(self) -> tuple[float, int, int] | None:
        self.queue.sort()
        if not self.queue or self.queue[-1][0] == -np.inf:
            return None
        return self.queue.pop()

    def gone(self, parent: int, unit: int) -> list:
        """The unit's paths that have been taken behind the same beginning."""
        name = (*((id(s), b, min(e, unit)) for s, b, e in self.paths[parent] if b < unit), unit)
        if name not in self.sets:
            self.sets[name] = [self.unit(parent, unit)]
        return self.sets[name]

    def unit(self, sample: int, unit: int) -> tuple:
        source = next(s for s, b, e in self.paths[sample] if b <= unit < e)
        if isinstance(source, tuple):
            return source[0]
        draw, shift = self.draws[source]
        paths, row = draw.paths, shift + unit
        own = slice(paths.offsets[row], paths.offsets[row + 1])
        return paths.at[own], paths.length[own], paths.piece[own], paths.log_prob[row]

    def add(self, value, parent, unit, arcs, ids, right, gone, behind) -> None:
        gone.append(arcs)
        draw, shift = behind
        self.draws.append(behind)
        head = [(s, b, min(e, unit)) for s, b, e in self.paths[parent] if b < unit]
        self.paths.append(
            [*head, ((arcs, ids, right), unit, unit + 1), (len(self.draws) - 1, unit + 1, self.n)]
        )
        log_prob = self.log_probs[parent].copy()
        log_prob[unit] = arcs[3]
        if unit + 1 < self.n:
            log_prob[unit + 1 :] = draw.paths.log_prob[shift + unit + 1 : shift + self.n]
        self.log_probs.append(log_prob)
        self.values.append(value)
        rest = left_over(log_prob[unit:])
        mass = 1 - sum(np.exp(g[3]) for g in gone)
        rest[0] = np.log(mass) if mass > LEAST else -np.inf
        before = (np.cumsum(log_prob) - log_prob)[unit:]
        u = uniform(mix(self.seeds[unit:] + np.uint64((len(self.paths) << 8) + 11)))
        self.enqueue(cut_gumbel(before + rest, value, u), len(self.paths) - 1, unit)

    def results(self) -> list[tuple]:
        kappa = max((q[0] for q in self.queue), default=-np.inf)
        out = []
        for path, log_prob, value in zip(self.paths, self.log_probs, self.values):
            total = float(log_prob.sum())
            inclusion = float(-np.expm1(-np.exp(min(total - kappa, 50.0))))
            parts, right = [], True
            for source, begin, end in path:
                if isinstance(source, tuple):
                    parts.append(source[1])
                    right &= source[2]
                elif begin < end:
                    draw, shift = self.draws[source]
                    a, b = shift + begin, shift + end
                    parts.append(draw.ids[draw.offsets[a] : draw.offsets[b]])
                    right &= bool(draw.right[a:b].all())
            out.append((np.concatenate(parts), total, value, inclusion, right))
        return out


def gathered(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the spans, one behind the other, and the lengths."""
    return data[spans(starts, lengths)], lengths


def in_order(members: list[np.ndarray], parts: list[Paths], n: int) -> Paths:
    """Paths of groups of units as those of all units, in their order."""
    units = np.concatenate(members)
    counts = np.zeros(n, np.int64)
    counts[units] = np.concatenate([np.diff(p.offsets) for p in parts])
    log_prob = np.zeros(n)
    log_prob[units] = np.concatenate([p.log_prob for p in parts])
    offsets = np.concatenate([[0], np.cumsum(counts)])
    own = counts[units]
    place = np.repeat(offsets[units] - (np.cumsum(own) - own), own) + np.arange(own.sum())
    arrays = []
    for name in ("at", "length", "piece"):
        flat = np.concatenate([getattr(p, name) for p in parts])
        out = np.empty_like(flat)
        out[place] = flat
        arrays.append(out)
    return Paths(offsets, *arrays, log_prob)


def row_seed(key, seed: int) -> int:
    digest = hashlib.blake2b(f"{seed}:{key}".encode(), digest_size=8).digest()
    return int.from_bytes(digest, "little")


@lru_cache(maxsize=1)
def _sampler(model: str, samples: int, seed: int, kept_bytes: int | None = None) -> Sampler:
    """The vocabulary and kept lattices, once for all tasks of a worker."""
    return Sampler(Vocabulary.load(model), samples, seed, kept_bytes)


FIELDS = (
    "sample int, n_pieces int, log_prob double, perturbed double, inclusion double,"
    " round_trip boolean, ids array<int>"
)


def sampled_encodings(
    df: DataFrame,
    model: str,
    key: str = "doc_id",
    text: str = "text",
    samples: int = SAMPLES,
    seed: int = SEED,
    kept_bytes: int | None = None,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """(key, sample, n_pieces, log_prob, perturbed, inclusion, round_trip, ids):
    up to ``samples`` distinct segmentations per row, drawn without replacement
    and seeded by the row's key.

    ``sample`` counts from 1, largest perturbed value first. ``inclusion`` is
    the chance to be among the samples given the first value that is not.
    ``round_trip`` says whether decoding gives the text back; the model writes a
    space and U+2581 alike, so one such sign counts as a space. Null and empty
    texts give one row, sample 0, without ids; a text with fewer segmentations
    gives fewer rows. Rows with the same key and text get the same samples, a
    null key counts as a key. Other columns are ignored. ``kept_bytes`` of units
    whose lattices a worker keeps, and ``slice_bytes`` of texts sampled together, change
    memory and time, not the result.
    """
    rows = bounded_batches(df.select(quoted(key), quoted(text)))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = _sampler(model, samples, seed, kept_bytes)
        for piece in slices(batches, text, slice_bytes):
            texts = [t or "" for t in piece.column(text).to_pylist()]
            found = sampler.run(texts, piece.column(key).to_pylist())
            place, fields, ids = [], [], []
            for i, own in enumerate(found):
                for s, (pieces, log_prob, value, inclusion, same) in enumerate(own):
                    place.append(i)
                    fields.append((s + 1, len(pieces), log_prob, value, inclusion, same))
                    ids.append(pieces)
                if not own:
                    place.append(i)
                    fields.append((0, 0, 0.0, None, None, True))
                    ids.append(np.zeros(0, np.int32))
            if not place:
                continue
            columns = list(zip(*fields))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32()))
            names = [f.split()[0] for f in FIELDS.split(",")]
            yield pa.RecordBatch.from_arrays(
                [piece.column(key).take(pa.array(place)), *arrays, lists], names=[key, *names]
            )

    return rows.mapInArrow(encode, with_fields(rows.select(quoted(key)), FIELDS))


@registered("op7_sampled_encodings")
def op7_sampled_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return sampled_encodings(docs, vocabulary_path("piece_bpe_32k.model"))
