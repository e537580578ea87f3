"""Exact top-k search by pruning blocks of documents.

A vector's components, scaled to whole numbers, are the weights of its terms.
Each shard orders its documents so that neighbours share their heaviest term and
cuts them into blocks; a block keeps the largest and smallest weight of every
term and a forward index (its documents' weights). The sum over terms of the
most that a block can add bounds the score of all its documents. A query's
blocks of largest bounds are scored first; of the others, those whose bound is not
below the query's k-th score by then. Where most queries need most of some blocks, these are
scored by one matrix product.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contestlab.llm.registry import registered
from contestlab.llm.tables import read
from contestlab.llm.vectors import SHARD_ROWS, Best, nearest, usable

HITS = 5
QUERY_EVERY = 50
SCALE = 256
BLOCK = 64
FIRST = 4  # blocks scored for a query before any bound is looked at
GROUP = 8  # blocks scored together before bounds are looked at again
DENSE = 0.25  # part of a group's queries and blocks from which all are scored
QUERY_ROWS = 2048
_SMALL = 1 << 24  # sums below are exact in single precision
_LARGEST = 1 << 53  # sums below are exact in doubles
_NOTHING = -float(1 << 60)


def build(ids: np.ndarray, values: np.ndarray) -> dict:
    heaviest = np.abs(values).argmax(axis=1)
    order = np.lexsort((ids, values[np.arange(len(ids)), heaviest], heaviest))
    ids, values = ids[order], values[order]
    if np.abs(values).max() < _SMALL:
        values = values.astype(np.float32)
    starts = np.arange(0, len(ids), BLOCK)
    return {
        "ids": ids,
        "values": values,
        "most": np.maximum.reduceat(values, starts, axis=0),
        "least": np.minimum.reduceat(values, starts, axis=0),
    }


def searcher(k: int):
    def search(index: dict, query_ids: np.ndarray, queries: np.ndarray):
        ids, values, most, least = (index[n] for n in ("ids", "values", "most", "least"))
        reach = np.abs(queries).sum(axis=1).max() * max(1.0, np.abs(values).max())
        if reach >= _LARGEST:
            raise ArithmeticError("components too large for exact scores")
        # Whole numbers, all of whose sums the type holds, whatever their order.
        kind = np.float32 if reach < _SMALL else np.float64
        queries, values, most, least = (x.astype(kind, copy=False) for x in (queries, values, most, least))
        bounds = np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T
        best = Best(query_ids, k, np.float64, _NOTHING)
        first = min(FIRST, len(most))
        leading = np.argpartition(-bounds, first - 1, axis=1)[:, :first]
        for block in np.unique(leading):
            own = np.flatnonzero((leading == block).any(axis=1))
            docs = slice(block * BLOCK, (block + 1) * BLOCK)
            best.offer(own, ids[docs], queries[own] @ values[docs].T)
        # No bound is left of what has been scored.
        np.put_along_axis(bounds, leading, -np.inf, axis=1)

        def score(rows: np.ndarray, blocks: np.ndarray) -> None:
            docs = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            docs = docs[docs < len(ids)]
            scores = queries[rows] @ values[docs].T
            row, column = np.nonzero(scores >= best.scores[rows, -1:].astype(kind))
            new = bounds[rows[row], docs[column] // BLOCK] > -np.inf
            row, column = row[new], column[new]
            best.offer_few(rows[row], ids[docs[column]], scores[row, column])

        order = np.argsort(-bounds.max(axis=0), kind="stable")
        for at in range(0, len(order), GROUP):
            blocks = order[at : at + GROUP]
            # A bound equal to the k-th score may hide a tie with a smaller id.
            open_ = bounds[:, blocks] >= best.scores[:, -1:]
            if open_.sum() >= DENSE * open_.size:
                score(np.flatnonzero(open_.any(axis=1)), blocks)
                continue
            for n in np.flatnonzero(open_.any(axis=0)):
                own = np.flatnonzero(open_[:, n])
                own = own[bounds[own, blocks[n]] >= best.scores[own, -1]]
                score(own, blocks[n : n + 1])
        place, found, scores = best.found()
        return place, found, scores.astype(np.int64)

    return search


def top_scores(
    vectors: DataFrame,
    k: int = HITS,
    query_every: int = QUERY_EVERY,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The ``k`` highest scores of every row whose id is divisible by
    ``query_every``, against all rows.

    Null ids, and vectors that are null, empty or hold null or non-finite
    components take no part; zero vectors do. Ties go to the smaller id. Scores
    that could pass 2**53 stop the query. See ``nearest`` for repeated ids and
    vectors of several lengths.
    """
    rows = usable(vectors, vec_id, embedding).withColumn(
        "v", F.transform("v", lambda x: F.floor(x * scale).cast("double"))
    )
    is_query = F.col("vec_id") % query_every == 0
    return nearest(rows, is_query, k, build, searcher(k), "bigint", shard_rows, QUERY_ROWS)


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % {QUERY_EVERY} = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {HITS}
"""


@registered("op9_top_scores", ORACLE)
def op9_top_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_scores(read(spark, sf_dir, "embeddings"))
