"""Connected components of links between texts, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestlab.llm.tables import salted_join
from contestlab.sources.scratch import written

SALTS = 8


def _are_stars(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u."""
    ends = edges.select(F.inline(F.expr("array(struct(u AS x, 1 AS out), struct(v AS x, 0 AS out))")))
    per_node = ends.groupBy("x").agg(F.sum("out").alias("outs"), F.min("out").alias("inner"))
    return per_node.where("outs > 1 OR (outs = 1 AND inner = 0)").isEmpty()


def _point_to_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m) for pairs (u, v): m is the least of u and all v of that u."""
    least = pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return salted_join(pairs, least, ["u"], SALTS)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that each node of ``edges`` (u, v) is
    connected with. Nodes of no edge and edges from a node to itself are left
    out.

    Each round points every node's larger neighbours, then every node and its
    smaller neighbours, to the least node around, until only stars are left; the
    rounds grow with the logarithm of the longest path, and a node with many
    links is spread over several tasks.
    """
    edges = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = written(edges.distinct(), "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _point_to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _point_to_least(large.distinct()).select(
            F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")
        )
        edges = written(small.where("u <> v").distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
