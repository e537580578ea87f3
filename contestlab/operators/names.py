"""Participant names: former names, and pairings written as one text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestlab.constants import PAIR_SEPARATOR, TEAM_NAMES
from contestlab.operators.attach import Lookup, MeasuredTable, attach, measured


def normalize_names(
    df: DataFrame,
    columns: Sequence[str],
    names: Mapping[str, str] | DataFrame | MeasuredTable = TEAM_NAMES,
) -> DataFrame:
    """Replace former names; other values and NULL stay.

    A dict becomes one conditional expression per column. A table
    (old_name, new_name), unique on old_name, is joined instead.
    """
    if not columns:
        return df
    if isinstance(names, Mapping):
        return df.replace(dict(names), subset=list(columns)) if names else df
    table = measured(names)
    for c in columns:
        found = attach(df, Lookup(table, {"old_name": c}, {"new_name": "_new_name"}))
        df = found.withColumn(c, F.coalesce("_new_name", c)).drop("_new_name")
    return df


def split_pair(
    df: DataFrame,
    column: str = "Team",
    into: tuple[str, str] = ("team_A", "team_B"),
    separator: str = PAIR_SEPARATOR,
) -> DataFrame:
    """Both names of "A vs B"; the second is NULL where there is no separator."""
    parts = F.split(F.col(column), rf"\Q{separator}\E")
    return df.withColumns({into[0]: F.get(parts, F.lit(0)), into[1]: F.get(parts, F.lit(1))})
