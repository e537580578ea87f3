"""Left joins of a table with one row per key.

A broadcast is used only for a table whose size was measured. A larger table
is joined by shuffle, with the heavy keys of the left side kept apart, so one
key with a third of all rows is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contestlab.sources.jobs import at_once
from contestlab.sources.scratch import written

BROADCAST_BYTES = 32 * 1024 * 1024
_ROW_OVERHEAD = 32


@dataclass(frozen=True)
class MeasuredTable:
    """A written table and its measured size; ``unique_on`` has the key sets
    that were found to be unique."""

    df: DataFrame
    rows: int
    bytes: int
    unique_on: set[tuple[str, ...]] = field(default_factory=set, compare=False)


def require_unique(table: MeasuredTable, keys: list[str]) -> None:
    """Raise ValueError if a key of the table has several rows; rows with a NULL
    in the key match nothing and do not count."""
    name = tuple(sorted(keys))
    if name in table.unique_on:
        return
    counts = table.df.select(*keys).dropna().groupBy(*keys).agg(F.count("*").alias("_n"))
    if not counts.where("_n > 1").isEmpty():
        raise ValueError(f"several rows for one key {', '.join(keys)}")
    table.unique_on.add(name)


def measured(
    table: DataFrame | MeasuredTable, unique: Sequence[str] | None = None
) -> MeasuredTable:
    """Write ``table`` and measure it, unless that was done before. ``unique`` names
    keys known to be unique, such as those that the table was grouped by; others
    are checked before they are joined on."""
    if isinstance(table, MeasuredTable):
        return table
    df = written(table, "lookup")
    width = F.lit(_ROW_OVERHEAD)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            width = width + 8 * F.coalesce(F.array_size(field.name), F.lit(0))
        else:
            width = width + F.lit(8)
    size = df.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    known = {tuple(sorted(unique))} if unique else set()
    return MeasuredTable(df, size["rows"], size["bytes"], known)


def measured_at_once(
    tables: Mapping[str, DataFrame | MeasuredTable],
    unique: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, MeasuredTable]:
    """Measure independent tables side by side."""
    waiting = {name: t for name, t in tables.items() if isinstance(t, DataFrame)}
    done = {name: t for name, t in tables.items() if isinstance(t, MeasuredTable)}
    if not waiting:
        return done
    keys = unique or {}
    spark = next(iter(waiting.values())).sparkSession
    work = {name: partial(measured, t, keys.get(name)) for name, t in waiting.items()}
    return done | at_once(spark, work)


def heavy_keys(left: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more rows than an even share of the shuffle partitions, hence
    fewer keys than partitions."""
    shares = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = written(
        left.select(*keys).dropna().groupBy(*keys).agg(F.count("*").alias("_n")), "key-counts"
    )
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.where(F.col("_n") * shares > total).drop("_n")


@dataclass(frozen=True)
class Lookup:
    """What to add: ``on`` maps key columns of the table to columns of the
    left side, ``values`` its value columns to their new names. The table must
    have one row per key."""

    table: DataFrame | MeasuredTable
    on: Mapping[str, str]
    values: Mapping[str, str]


def attach(
    left: DataFrame, *lookups: Lookup, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add columns to every row of ``left``; its row count is kept. Rows
    without a match get NULL, columns of the same name are replaced. A table with
    several rows for a key is a ValueError."""
    names = [n for lookup in lookups for n in lookup.values.values()]
    left = left.drop(*names)
    out = left
    for lookup in lookups:
        right = measured(lookup.table)
        keys = list(lookup.on.values())
        _check_types(left, right.df, lookup.on)
        require_unique(right, list(lookup.on))
        rows = right.df.select(
            *[F.col(r).alias(l) for r, l in lookup.on.items()],
            *[F.col(r).alias(n) for r, n in lookup.values.items()],
        ).dropna(subset=keys)
        if right.bytes <= broadcast_bytes:
            out = out.join(F.broadcast(rows), keys, "left").select(
                *out.columns, *lookup.values.values()
            )
        else:
            # Heavy keys are counted before any join, not after the last one.
            out = _attach_by_shuffle(out, rows, keys, heavy_keys(left, keys))
    return out


def _check_types(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> None:
    """Equal values meet by hash, so their types must be equal too."""
    for r, l in on.items():
        if left.schema[l].dataType != right.schema[r].dataType:
            raise TypeError(f"key {l} is {left.schema[l].dataType}, not as {r} of the table")


def _attach_by_shuffle(
    left: DataFrame, rows: DataFrame, keys: list[str], hot: DataFrame
) -> DataFrame:
    names = [n for n in rows.columns if n not in keys]
    # The heavy keys are fewer than the shuffle partitions, so this is small. A
    # heavy key without a row in the table is heavy all the same.
    hot_rows = hot.join(rows.join(F.broadcast(hot), keys, "left_semi"), keys, "left").select(
        *keys, F.lit(True).alias("_hot"), *[F.col(n).alias(f"_hot_{n}") for n in names]
    )
    marked = left.join(F.broadcast(hot_rows), keys, "left")

    # Rows with a key of their own meet by a hash of it. Rows that need no
    # partner below (heavy or NULL key) are spread by a hash of the whole row
    # and its partition, which a retried task computes again.
    alone = F.col("_hot")
    for k in keys:
        alone = alone | F.col(k).isNull()
    own, by_row = F.hash(*keys), F.hash(F.spark_partition_id(), *left.columns)
    spread = marked.withColumn("_spread", F.when(alone, by_row).otherwise(own))
    cold = rows.withColumn("_spread", own).hint("shuffle_merge")
    joined = spread.join(cold, [*keys, "_spread"], "left")
    return joined.select(
        *left.columns,
        *[
            F.when(F.col("_hot"), F.col(f"_hot_{n}")).otherwise(F.col(n)).alias(n)
            for n in names
        ],
    )
