"""Fitted models as tables, and their answers as joins and sums.

An ensemble is a table of nodes that rows walk down, one join per level; a
perceptron is a table of weights, one join and one sum per layer; a linear model
is a table of coefficients. The tables have the size of the model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contestlab.operators.attach import Lookup, MeasuredTable, attach, measured
from contestlab.sources.scratch import scratch_path

NODE = ("split_on", "continuous", "split_at", "left_child", "right_child", "prediction", "stats")


def node_table(model: Model, spark: SparkSession) -> MeasuredTable:
    """(tree, node, ...) of a fitted forest or of boosted trees, from the files it
    is saved as. ``split_at`` has the threshold or the categories that go left;
    children of a leaf are -1."""
    path = scratch_path(spark, "ensemble")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    table = data.select(
        "tree",
        F.col("id").alias("node"),
        F.col("split.featureIndex").alias("split_on"),
        (F.col("split.numCategories") < 0).alias("continuous"),
        F.col("split.leftCategoriesOrThreshold").alias("split_at"),
        F.col("leftChild").alias("left_child"),
        F.col("rightChild").alias("right_child"),
        "prediction",
        F.col("impurityStats").alias("stats"),
    )
    return measured(table, ["tree", "node"])


def dealt(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by ``keys``, in as many parts as shuffles have: each becomes many
    below, and sums by the keys and more then stay where the row is."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *keys)


def leaves(
    rows: DataFrame, nodes: MeasuredTable, trees: int, depth: int, vector: str = "features"
) -> DataFrame:
    """Every row once per tree, with ``tree`` and the ``prediction`` and ``stats`` of
    the leaf that it ends in. Its other columns, but for the vector, are kept."""
    kept = [c for c in rows.columns if c not in (vector, "prediction")]
    at = rows.select(
        *kept,
        vector_to_array(vector).alias("slots"),
        F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"),
        F.lit(0).alias("node"),
    )
    here = Lookup(nodes, {"tree": "tree", "node": "node"}, {n: n for n in NODE})
    value = F.get("slots", F.col("split_on"))
    left = F.when(F.col("continuous"), value <= F.get("split_at", F.lit(0))).otherwise(
        F.array_contains("split_at", value)
    )
    child = F.when(left, F.col("left_child")).otherwise(F.col("right_child"))
    step = F.when(F.col("left_child") < 0, F.col("node")).otherwise(child)
    for _ in range(depth):
        at = attach(at, here).select(*kept, "slots", "tree", step.alias("node"))
    return attach(at, here).select(*kept, "tree", "prediction", "stats")


def forest_probability(
    rows: DataFrame, model: Model, keys: Sequence[str], name: str = "from_nodes"
) -> DataFrame:
    """(keys, name): the mean over the trees of the share of wins in a row's leaf."""
    nodes = node_table(model, rows.sparkSession)
    found = leaves(
        dealt(rows.select(*keys, "features"), keys), nodes, model.getNumTrees, model.getMaxDepth()
    )
    share = F.get("stats", F.lit(1)) / F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    return found.groupBy(*keys).agg(F.avg(share).alias(name))


def boosted_margin(
    rows: DataFrame, model: Model, keys: Sequence[str], name: str = "from_nodes"
) -> DataFrame:
    """(keys, name): the weighted sum over the trees of a row's leaves."""
    nodes = node_table(model, rows.sparkSession)
    weights = F.array(*map(F.lit, model.treeWeights))
    found = leaves(
        dealt(rows.select(*keys, "features"), keys), nodes, len(model.treeWeights), model.getMaxDepth()
    )
    weighted = F.col("prediction") * F.get(weights, F.col("tree"))
    return found.groupBy(*keys).agg(F.sum(weighted).alias(name))


def weight_table(model: Model, spark: SparkSession) -> DataFrame:
    """(layer, source, target, weight) of a fitted perceptron; the source of a bias
    is -1. A layer's weights come by source, then its biases."""
    sizes = model.getLayers()
    numbers, at, rows = model.weights.toArray().tolist(), 0, []
    for layer, (n, m) in enumerate(zip(sizes, sizes[1:])):
        for source in [*range(n), -1]:
            rows += [(layer, source, t, numbers[at + t]) for t in range(m)]
            at += m
    return spark.createDataFrame(rows, "layer int, source int, target int, weight double")


def perceptron_probability(
    rows: DataFrame, model: Model, keys: Sequence[str], name: str = "from_weights"
) -> DataFrame:
    """(keys, name): the probability of the second class, layer by layer: joined
    with the layer's weights, summed per target, and bent by the logistic curve."""
    weights = weight_table(model, rows.sparkSession)
    last = len(model.getLayers()) - 2
    signal = (
        dealt(rows.select(*keys, "features"), keys)
        .select(*keys, F.posexplode(vector_to_array("features")).alias("source", "x"))
        .where("x <> 0 OR source = 0")
    )
    for layer in range(last + 1):
        own = weights.where(F.col("layer") == layer)
        bias = own.where("source = -1").select("target", F.col("weight").alias("bias"))
        # The tables are as large as the model's layer.
        met = signal.join(F.broadcast(own.where("source >= 0")), "source")
        sums = met.groupBy(*keys, "target").agg(F.sum(F.col("x") * F.col("weight")).alias("z"))
        sums = sums.join(F.broadcast(bias), "target").withColumn("z", F.col("z") + F.col("bias"))
        if layer < last:
            out = (1 / (1 + F.exp(-F.col("z")))).alias("x")
            signal = sums.select(*keys, F.col("target").alias("source"), out)
    gap = F.sum(F.when(F.col("target") == 1, F.col("z")).otherwise(-F.col("z")))
    return sums.groupBy(*keys).agg((1 / (1 + F.exp(-gap))).alias(name))


def linear_margin(
    rows: DataFrame,
    coefficients: Mapping[str, float],
    intercept: float,
    keys: Sequence[str],
    name: str = "margin",
) -> DataFrame:
    """(keys, name): the rows' columns, one row each, joined with a table of
    coefficients by column name and summed."""
    spark = rows.sparkSession
    table = spark.createDataFrame(list(coefficients.items()), "input string, weight double")
    cells = F.array(
        *[F.struct(F.lit(n).alias("input"), F.col(n).cast("double").alias("x")) for n in coefficients]
    )
    met = rows.select(*keys, F.inline(cells)).join(F.broadcast(table), "input")
    total = F.sum(F.col("x") * F.col("weight")) + F.lit(intercept)
    return met.groupBy(*keys).agg(total.alias(name))


def logistic(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))
