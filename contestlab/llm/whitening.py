"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided
Jacobi on the triangular factor.

A vector's entries become whole numbers, so sums are exact. Tasks sum what they
read - first the vectors, then the products of the centred vectors, in blocks -
and send sums only, whose size depends on the dimensions and not on the rows.
The scatter matrix A = G G' is factored by Cholesky steps with the largest
remaining diagonal first, which also finds its rank. Rotations from the right
make the columns of G orthogonal: their squared lengths are then the eigenvalues
of A, and the columns at length one its eigenvectors. A row's whitened entry is
the projection of its centred vector on a component over the component's
deviation.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contestlab.llm.registry import registered
from contestlab.llm.tables import quoted, read

COMPONENTS = 32
STEPS = 64  # whole numbers to an entry of one
SHIFT = 1_000_000
BLOCK_ROWS = 8192
SWEEPS = 60
_LARGEST = 2.0**62
_LONG = 2**63 - 1


def whole_vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimensions, rows, x) for the usable vectors of a batch of lists: those
    that are not null or empty and have finite entries only. x is floor(64 c) +
    1000000; an entry too large for that counts as the nearest that is not."""
    column = batch.column(1)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(lengths)
    good = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    usable = (lengths > 0) & (good[ends] == good[ends - lengths])
    for d in np.unique(lengths[usable]).tolist():
        rows = np.flatnonzero(usable & (lengths == d))
        for at in range(0, len(rows), BLOCK_ROWS):
            own = rows[at : at + BLOCK_ROWS]
            c = flat[(ends - lengths)[own][:, None] + np.arange(d)]
            with np.errstate(over="ignore"):
                steps = np.clip(np.floor(STEPS * c), -_LARGEST, _LARGEST)
            yield d, own, steps.astype(np.int64) + SHIFT


def exact_sum(x: np.ndarray) -> np.ndarray:
    """Column sums of whole numbers, as Python integers where 64 bits may not do."""
    largest = max(abs(int(x.max())), abs(int(x.min())), 1)
    return x.sum(axis=0) if largest < _LONG // len(x) else x.astype(object).sum(axis=0)


def column_sums(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Rows and exact column sums of the usable vectors, by dimensions."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for d, rows, x in whole_vectors(batch):
                n, s = sums.get(d, (0, np.zeros(d, object)))
                sums[d] = n + len(rows), s + exact_sum(x)
        for d, (n, s) in sums.items():
            values = pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0))
            columns = [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([n] * d, pa.int64()), values], names=["d", "i", "n", "s"]
            )

    parts = vectors.mapInArrow(add, "d int, i int, n bigint, s decimal(38,0)")
    found = parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out: dict[int, tuple[int, list[int]]] = {}
    # One number for each dimension, however many rows there are.
    for r in sorted(found.collect()):
        n, s = out.setdefault(r["d"], (r["n"], []))
        s.append(int(r["s"]))
    return out


@dataclass(frozen=True)
class Centre:
    """The mean S / n as whole numbers and what is left over, of which
    ``remainder`` is n times."""

    n: int
    whole: np.ndarray
    remainder: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int]) -> Centre:
        parts = [divmod(s, n) for s in sums]
        return cls(n, np.array([q for q, _ in parts], np.int64), np.array([r for _, r in parts], np.int64))

    def subtract(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.remainder / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums over the dimensions of (n x - S)^2."""
        z = x - self.whole
        largest = max(abs(int(z.max())), abs(int(z.min()))) + 1
        if x.shape[1] * (self.n * largest) ** 2 <= _LONG:
            return ((self.n * z - self.remainder) ** 2).sum(axis=1).tolist()
        z = z.astype(object)
        return ((self.n * z - self.remainder.astype(object)) ** 2).sum(axis=1).tolist()


def scatters(vectors: DataFrame, of) -> dict[int, np.ndarray]:
    """Sum of the outer products of ``of(d, x)`` over the usable vectors, by
    dimensions. A task sends one matrix, row by row; rows meet by their number
    and are added one at a time, so no task holds several matrices."""

    def rows(found: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
        for (d, i), row in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d], pa.int32()), pa.array([i], pa.int32()), pa.array([row.tolist()])],
                names=["d", "i", "row"],
            )

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in whole_vectors(batch):
                z = of(d, x)
                sums[d] = sums.get(d, 0.0) + z.T @ z
        yield from rows({(d, i): row for d, s in sums.items() for i, row in enumerate(s)})

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for d, i, row in zip(*(c.to_pylist() for c in batch.columns)):
                sums[d, i] = sums.get((d, i), 0.0) + np.array(row)
        yield from rows(sums)

    fields = "d int, i int, row array<double>"
    parts = vectors.mapInArrow(multiply, fields).repartition("d", "i")
    out: dict[int, list[np.ndarray]] = {}
    for r in sorted(parts.mapInArrow(add, fields).collect(), key=lambda r: (r["d"], r["i"])):
        out.setdefault(r["d"], []).append(np.array(r["row"]))
    return {d: np.stack(found) for d, found in out.items()}


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order): with its rows in this order, ``a`` is the product of the
    lower triangular factor and its transpose. The factor has as many columns
    as ``a`` has rank, up to rounding."""
    d = len(a)
    left, order = np.array(a, np.float64), np.arange(d)
    factor = np.zeros((d, d))
    least = d * np.finfo(np.float64).eps * max(float(left.diagonal().max(initial=0.0)), 0.0)
    for k in range(d):
        at = k + int(np.argmax(left.diagonal()[k:]))
        if not left[at, at] > least:
            return factor[:, :k], order
        for m in (left, factor):
            m[[k, at]] = m[[at, k]]
        left[:, [k, at]] = left[:, [at, k]]
        order[[k, at]] = order[[at, k]]
        factor[k:, k] = left[k:, k] / np.sqrt(left[k, k])
        left[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` with its columns rotated, two and two, until all are orthogonal.
    A round takes disjoint pairs at once; the rounds of a sweep meet all pairs."""
    columns = np.ascontiguousarray(factor.T)
    n = len(columns)
    ring = np.arange(n + n % 2)  # an odd number of columns has one that rests
    half = len(ring) // 2
    tolerance = np.finfo(np.float64).eps * 4
    for _ in range(SWEEPS):
        rotated = False
        for _ in range(len(ring) - 1):
            p, q = ring[:half], ring[half:][::-1]
            p, q = p[(p < n) & (q < n)], q[(p < n) & (q < n)]
            a, b = columns[p], columns[q]
            aa, bb, ab = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
            turn = np.abs(ab) > tolerance * np.sqrt(aa * bb)
            if turn.any():
                rotated = True
                p, q, a, b = p[turn], q[turn], a[turn], b[turn]
                zeta = (bb - aa)[turn] / (2 * ab[turn])
                t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = (1 / np.hypot(1.0, t))[:, None]
                s = c * t[:, None]
                columns[p], columns[q] = c * a - s * b, s * a + c * b
            ring[1:] = np.roll(ring[1:], 1)
        if not rotated:
            break
    return columns.T


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues of ``a``, falling, and unit eigenvectors as columns."""
    factor, order = pivoted_cholesky(a)
    rotated = np.empty_like(factor)
    rotated[order] = jacobi(factor)
    lengths = np.sqrt((rotated**2).sum(axis=0))
    falling = np.argsort(-lengths, kind="stable")
    return lengths[falling] ** 2, rotated[:, falling] / lengths[falling]


@dataclass(frozen=True)
class Whitening:
    """``projection`` has one column per component, over its deviation."""

    centre: Centre
    projection: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centre.subtract(x) @ self.projection


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """Centres and components of the usable vectors, by dimensions. Vectors of
    one value everywhere, as a single vector, have no component."""
    centres = {d: Centre.of(n, sums) for d, (n, sums) in column_sums(vectors).items()}
    if not centres:
        return {}
    fitted = {}
    for d, scatter in scatters(vectors, lambda d, x: centres[d].subtract(x)).items():
        covariance = scatter / centres[d].n
        values, parts = eigen((covariance + covariance.T) / 2)
        k = min(components, len(values))
        trace = float(np.trace(covariance))
        fitted[d] = Whitening(
            centres[d], parts[:, :k] / np.sqrt(values[:k]), values[:k] / trace if k else values
        )
    # Whitened rows are centred, as they are projections of centred rows.
    checks = scatters(vectors, lambda d, x: fitted[d].whiten(x))
    out = {}
    for d, w in fitted.items():
        k = w.projection.shape[1]
        off = np.abs(checks[d] / w.centre.n - np.eye(k)).max() if k else 0.0
        out[d] = Whitening(w.centre, w.projection, w.explained, float(off))
    return out


FIELDS = (
    "component int, n bigint, deviation decimal(38,0), whitened double, explained double,"
    " identity_error double"
)


def whitened(
    df: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): one
    row for each usable vector and component, components numbered from 1.

    Null and empty vectors and those with a null or non-finite entry are left
    out; rows with a null or repeated id are kept. Vectors of several lengths are
    whitened by length: each has its own centre, components and ``n``. There are
    no more components than the covariance has rank, up to rounding: one vector, or equal
    ones, give no rows, as does an empty table. Other columns are ignored. A
    deviation of more than 38 digits is null. Entries of 2^56 or more count as
    the largest that a whole number holds.

    What is fitted has a size that depends on the vectors' lengths only; it is
    computed at the driver and broadcast.
    """
    vectors = df.select(quoted(vec_id), quoted(embedding).cast("array<double>"))
    models = df.sparkSession.sparkContext.broadcast(fit(vectors, components))
    names = [vec_id, *(f.split()[0] for f in FIELDS.split(", "))]
    kind = df.select(quoted(vec_id)).schema[0].dataType.simpleString()

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, x in whole_vectors(batch):
                model = models.value[d]
                k = model.projection.shape[1]
                if not k:
                    continue
                found = [Decimal(v) if v < 10**38 else None for v in model.centre.deviations(x)]
                ids = batch.column(0).take(pa.array(np.repeat(rows, k)))
                m = len(rows)
                repeated = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, model.centre.n)),
                        pa.array(found, pa.decimal128(38, 0)).take(repeated),
                        pa.array(model.whiten(x).ravel()),
                        pa.array(np.tile(model.explained, m)),
                        pa.array(np.full(m * k, model.identity_error)),
                    ],
                    names=names,
                )

    quoted_id = vec_id.replace("`", "``")
    return vectors.mapInArrow(project, f"`{quoted_id}` {kind}, {FIELDS}")


@registered("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation that no long holds is null."""
    out = whitened(read(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
