"""Mixing sources to target weights by fitting word budgets.

Each source gets a target number of words. Whole passes over the source come
first; what is left of the target is a subset-sum problem. Documents stand in a
seeded order (a hash of id and text), and all documents before a cut are taken.
The cut is found by counting words per hash prefix, four bits at a time, until
the documents behind the cut that share its prefix are a small pool. In the
pool, documents are counted by exact length, a bounded-knapsack table over the
remaining budget says how many of each length to take, and those come in the
seeded order. No step sorts or gathers the documents of a source, so one source
may hold most rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contestlab.llm.registry import registered
from contestlab.llm.tables import fresh, quoted, read
from contestlab.operators.attach import Lookup, attach
from contestlab.sources.scratch import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2
SEED = 17
POOL_DOCUMENTS = 4096
TABLE_WORDS = 1 << 16
WORD = "[^\\x20\\x09-\\x0D]+"
_BITS = 60
_STEP = 4


@dataclass(frozen=True)
class Mix:
    """What the mix asks for: weights repeat along the sources in code point
    order, null last; the targets add up to ``share`` times all words as far as
    no source exceeds ``passes`` times its own."""

    weights: Sequence[int] = WEIGHTS
    share: float = SHARE
    passes: int = MOST_PASSES
    seed: int = SEED
    pool: int = POOL_DOCUMENTS
    table_words: int = TABLE_WORDS


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(quoted(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def order_of(doc_id: str, text: str, seed: int) -> Column:
    """60 bits of a hash of id and text: the place in the seeded order."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), quoted(doc_id), quoted(text)), 64 - _BITS)


def source_key(source: str) -> Column:
    """A text that is never null and tells a null source from every other."""
    return F.when(quoted(source).isNull(), F.lit("null")).otherwise(
        F.concat(F.lit("="), quoted(source).cast("string"))
    )


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(src, source_size, target): one row per source, from the counted sizes.

    Only sums of weights and words reach the driver. Sources whose share is
    above their limit get the limit, and the rest is shared anew.
    """
    ranked = Window.orderBy((F.col("src") == "null").asc(), "src")
    pattern = F.array(*[F.lit(int(w)) for w in mix.weights])
    place = (F.row_number().over(ranked) - 1) % len(mix.weights)
    per_source = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    table = written(
        per_source.select("src", "source_size", F.get(pattern, place).alias("weight")), "sources"
    )
    limit = F.col("source_size") * F.lit(float(mix.passes))
    total = float(table.agg(F.sum("source_size")).first()[0] or 0) * mix.share
    unit, below = None, -1
    while True:
        above = F.lit(False) if unit is None else F.col("weight") * F.lit(unit) >= limit
        sums = table.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)).alias("given"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
            F.count(F.when(~above, 1)).alias("below"),
        ).first()
        if sums["below"] == below or not sums["weight"]:
            break
        below = sums["below"]
        unit = (total - sums["given"]) / sums["weight"]
    share = limit if unit is None else F.least(F.col("weight") * F.lit(unit), limit)
    return table.select("src", "source_size", share.alias("target"))


def cuts(rows: DataFrame, goals: DataFrame, mix: Mix) -> DataFrame:
    """(src, lo, hi, rest): take all documents whose order is below ``lo``; a
    pool between ``lo`` and ``hi`` has to give ``rest`` more words."""
    size = F.col("source_size")
    passes = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0))
    counts = rows.groupBy("src").agg(F.count("*").alias("n"))
    state = goals.join(counts, "src").select(
        "src",
        F.lit(0).cast("bigint").alias("lo"),
        F.lit(_BITS).alias("bits"),
        F.floor(F.col("target") - passes * size).cast("bigint").alias("rest"),
        "n",
    )
    done: list[DataFrame] = []
    for _ in range(0, _BITS - _STEP, _STEP):
        state = written(state, "cuts")
        open_ = (F.col("n") > mix.pool) & (F.col("rest") > 0)
        done.append(state.where(~open_))
        state = state.where(open_)
        if state.isEmpty():
            break
        step = F.expr(f"shiftright(h - lo, bits - {_STEP})")
        per_prefix = (
            rows.join(state, "src")
            .where("h >= lo AND shiftright(h - lo, bits) = 0")
            .groupBy("src", "lo", "bits", "rest", step.alias("part"))
            .agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        )
        # At most 2**_STEP rows per source from here on.
        so_far = F.sum("words").over(Window.partitionBy("src").orderBy("part"))
        state = (
            per_prefix.withColumn("so_far", so_far)
            .where("rest < so_far")
            .groupBy("src")
            .agg(F.min_by(F.struct("lo", "bits", "rest", "part", "words", "so_far", "n"), "part").alias("c"))
            .select(
                "src",
                F.expr(f"c.lo + shiftleft(c.part, c.bits - {_STEP})").alias("lo"),
                (F.col("c.bits") - _STEP).alias("bits"),
                (F.col("c.rest") - F.col("c.so_far") + F.col("c.words")).alias("rest"),
                F.col("c.n").alias("n"),
            )
        )
    else:
        done.append(state)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("src", "lo", F.expr("lo + shiftleft(1L, bits)").alias("hi"), "rest")


def fit(orders: np.ndarray, sizes: np.ndarray, budget: int, table_words: int) -> np.ndarray:
    """Which documents to take so that their sizes come as near to the budget as
    they can without passing it. Leading documents are taken until the budget
    left fits the table; the rest is counted by length and fitted exactly."""
    place = np.lexsort((sizes, orders))
    taken = np.zeros(len(sizes), bool)
    sums = np.cumsum(sizes[place])
    lead = np.searchsorted(sums, budget - table_words, "right") if budget > table_words else 0
    taken[place[:lead]] = True
    budget -= int(sums[lead - 1]) if lead else 0
    rest = place[lead:]
    rest = rest[(sizes[rest] > 0) & (sizes[rest] <= budget)]
    by_length = {n: rest[sizes[rest] == n] for n in np.unique(sizes[rest]).tolist()}

    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    first = np.full(budget + 1, -1, np.int32)  # the part that first reached a sum
    parts: list[tuple[int, int]] = []  # (length, documents)
    for length, docs in by_length.items():
        left, block = len(docs), 1
        while left:
            block = min(block, left)
            left -= block
            weight = length * block
            if weight <= budget:
                new = reached[: budget + 1 - weight] & ~reached[weight:]
                at = np.flatnonzero(new) + weight
                first[at] = len(parts)
                reached[at] = True
                parts.append((length, block))
            block *= 2
    total = int(np.flatnonzero(reached)[-1])
    counts = dict.fromkeys(by_length, 0)
    while total:
        length, block = parts[first[total]]
        counts[length] += block
        total -= length * block
    for length, docs in by_length.items():
        taken[docs[: counts[length]]] = True
    return taken


def chosen(rows: DataFrame, cut: DataFrame, mix: Mix) -> DataFrame:
    """(src, h) of the pool documents to take. Rows that repeat id and text
    share an order and are taken together."""
    pool = (
        rows.join(cut.where("rest > 0"), "src")
        .where("h >= lo AND h < hi AND size > 0")
        .groupBy("src", "h", "rest")
        .agg(F.sum("size").alias("size"))
    )
    table_words = mix.table_words

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        taken = fit(
            group["h"].to_numpy(), group["size"].to_numpy(), int(group["rest"].iloc[0]), table_words
        )
        return group.loc[taken, ["src", "h"]]

    return pool.groupBy("src").applyInPandas(choose, "src string, h bigint")


def mixed(
    df: DataFrame,
    mix: Mix = Mix(),
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``copies`` (how often the
    mix takes the row; under fresh names if taken) to every row.

    Null and empty texts have size 0 and are taken in whole passes only. A null
    source is a source, the last. Rows with equal id and text are taken alike.
    No rows give no rows. Reruns agree, however the rows are partitioned.
    """
    names = fresh(df.columns, "size", "source_size", "target", "copies")
    own = fresh([*df.columns, *names], "_src", "_h", "_lo", "_chosen")
    src, h, lo, hit = own
    sized = df.withColumns(
        {names[0]: size_of(text), src: source_key(source), h: order_of(doc_id, text, mix.seed)}
    )
    rows = written(
        sized.select(quoted(src).alias("src"), quoted(h).alias("h"), quoted(names[0]).alias("size")),
        "sizes",
    )
    goals = written(targets(rows, mix), "targets")
    cut = written(cuts(rows, goals, mix), "cuts")
    picks = chosen(rows, cut, mix).withColumn("chosen", F.lit(1))
    per_source = goals.join(cut, "src")
    out = attach(
        sized,
        Lookup(
            per_source,
            {"src": src},
            {"source_size": names[1], "target": names[2], "lo": lo},
        ),
        Lookup(picks, {"src": src, "h": h}, {"chosen": hit}),
    )
    whole = F.when(
        quoted(names[1]) > 0, F.floor(quoted(names[2]) / quoted(names[1]))
    ).otherwise(F.lit(0))
    more = F.coalesce((quoted(h) < quoted(lo)).cast("int"), F.lit(0)) + F.coalesce(
        quoted(hit), F.lit(0)
    )
    # With the whole target given in passes there is no cut and no pool.
    return out.withColumn(names[3], (whole + more).cast("int")).drop(*own)


@registered("op8_mix_sources")
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = mixed(docs)
    return out.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
    )
