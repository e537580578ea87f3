"""A stated set of query vectors against all vectors, in blocks.

All vectors are dealt to shards of bounded size, by a hash of id and vector, and
each shard is packed into one row with whatever index its search needs. Queries
are packed into blocks of bounded size. Every pair of a shard and a query block
is one row of a join; searching it gives each query its best of that shard, and
the best over all shards are the result.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contestlab.llm.tables import shuffled_join

SHARD_ROWS = 4096
QUERY_ROWS = 512

Build = Callable[[np.ndarray, np.ndarray], Any]
# (index, query ids, queries) -> (places of the queries, ids found, their scores)
Search = Callable[[Any, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v, dim) of the rows that take part: no null id, and a vector
    that is not null or empty and has finite components only."""
    finite = F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return (
        vectors.select(
            F.col(vec_id).cast("bigint").alias("vec_id"),
            F.col(embedding).cast("array<double>").alias("v"),
        )
        .where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite)
        .withColumn("dim", F.size("v"))
    )


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    table = table.combine_chunks()
    ids = table.column("vec_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    values = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return ids[order], values.reshape(len(ids), -1)[order]


def _parts(df: DataFrame, rows: int) -> int:
    return max(1, -(-df.count() // rows))


def _packed(df: DataFrame, name: str, rows: int, build: Build) -> tuple[DataFrame, int]:
    n = _parts(df, rows)

    def pack(keys: tuple, table: pa.Table) -> pa.Table:
        ids, values = _matrix(table)
        blob = pickle.dumps(build(ids, values))
        return pa.table(
            {
                "dim": pa.array([keys[0].as_py()], pa.int32()),
                name: pa.array([keys[1].as_py()], pa.int64()),
                f"{name}_data": pa.array([blob], pa.binary()),
            }
        )

    dealt = df.withColumn(name, F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)))
    schema = f"dim int, {name} bigint, {name}_data binary"
    return dealt.groupBy("dim", name).applyInArrow(pack, schema), n


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    build: Build,
    search: Search,
    score_type: str,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best, higher scores
    first, ties to the smaller id. ``vectors`` come from ``usable``.

    Vectors are compared with those of equal length. Rows with the query's own
    id are never found. An id with several vectors asks with the smallest, and
    each of its rows can be found. No vectors or no queries give no rows.
    """
    shards, n = _packed(vectors, "shard", shard_rows, build)
    asked = vectors.where(is_query).groupBy("vec_id", "dim").agg(F.min("v").alias("v"))
    asked = asked.groupBy("vec_id").agg(F.min_by("v", "dim").alias("v"), F.min("dim").alias("dim"))
    blocks, parts = _packed(asked, "block", query_rows, lambda ids, values: (ids, values))
    # Small as they are, blocks would share a task, which would copy all of them for all shards.
    blocks = blocks.repartition(parts, "block")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    pairs = shuffled_join(shards, blocks.withColumn("shard", every), ["dim", "shard"])
    pairs = pairs.select("shard_data", "block_data")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.int64() if score_type == "bigint" else pa.float64()
        for batch in batches:
            for shard, block in zip(batch.column(0), batch.column(1)):
                ids, queries = pickle.loads(block.as_py())
                place, found, scores = search(pickle.loads(shard.as_py()), ids, queries)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[place]), pa.array(found), pa.array(scores, kind)],
                    names=["query_id", "vec_id", "score"],
                )

    found = pairs.mapInArrow(run, f"query_id bigint, vec_id bigint, score {score_type}")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


class Best:
    """The best ``k`` (score, id) of each query so far, best first."""

    def __init__(self, query_ids: np.ndarray, k: int, dtype: type, least: float):
        self.query_ids, self.least = query_ids, least
        self.scores = np.full((len(query_ids), k), least, dtype)
        self.ids = np.full((len(query_ids), k), np.iinfo(np.int64).max)

    def offer(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Offer candidates ``ids`` to the queries ``rows``, with their scores
        by query and candidate. A query's own id is left out."""
        scores = np.where(ids[None, :] == self.query_ids[rows][:, None], self.least, scores)
        better = (scores >= self.scores[rows, -1:]).any(axis=1)
        rows, scores = rows[better], scores[better]
        if not len(rows):
            return
        all_scores = np.concatenate([self.scores[rows], scores], axis=1)
        all_ids = np.concatenate(
            [self.ids[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1
        )
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.scores.shape[1]]
        self.scores[rows] = np.take_along_axis(all_scores, order, axis=1)
        self.ids[rows] = np.take_along_axis(all_ids, order, axis=1)

    def offer_few(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Offer single candidates: a query, an id and its score each. A query's own
        id is left out, and so are those that its ``k``-th best is before."""
        last, tied = self.scores[rows, -1], self.ids[rows, -1]
        kept = (scores > last) | (scores == last) & (ids < tied)
        kept &= ids != self.query_ids[rows]
        rows, ids, scores = rows[kept], ids[kept], scores[kept]
        own, k = np.unique(rows), self.scores.shape[1]
        rows = np.concatenate([np.repeat(own, k), rows])
        ids = np.concatenate([self.ids[own].ravel(), ids])
        scores = np.concatenate([self.scores[own].ravel(), scores])
        order = np.lexsort((ids, -scores, rows))
        starts = np.searchsorted(rows[order], own)
        counts = np.diff(np.append(starts, len(rows)))
        best = order[np.arange(len(rows)) - np.repeat(starts, counts) < k]
        self.scores[own] = scores[best].reshape(-1, k)
        self.ids[own] = ids[best].reshape(-1, k)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place, column = np.nonzero(self.scores > self.least)
        return place, self.ids[place, column], self.scores[place, column]
