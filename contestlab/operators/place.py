"""Home ground and neutral ground."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contestlab.columns import CONTEST, ContestColumns
from contestlab.constants import HOME_CITIES, TEAM_NAMES
from contestlab.operators.attach import Lookup, MeasuredTable, attach, measured
from contestlab.operators.names import normalize_names


def home_table(
    spark: SparkSession,
    homes: Mapping[str, Sequence[str]] = HOME_CITIES,
    names: Mapping[str, str] = TEAM_NAMES,
) -> DataFrame:
    """Distinct (team, city), under current names."""
    rows = [(team, city) for team, cities in homes.items() for city in cities]
    return current_homes(spark.createDataFrame(rows, "team string, city string"), names)


def current_homes(homes: DataFrame, names: Mapping[str, str] | DataFrame) -> DataFrame:
    return normalize_names(homes, ["team"], names).select("team", "city").distinct()


def with_neutral_flag(
    df: DataFrame,
    homes: DataFrame | MeasuredTable,
    c: ContestColumns = CONTEST,
    name: str = "neutral_venue",
) -> DataFrame:
    """0 where the city is home to either side, else 1 (unknown city included)."""
    if not isinstance(homes, MeasuredTable):
        homes = measured(homes.withColumn("is_home", F.lit(1)))
    # Several rows for a home are an error, as in every lookup.
    out = attach(
        df,
        Lookup(homes, {"team": c.side_a, "city": c.city}, {"is_home": "_home_a"}),
        Lookup(homes, {"team": c.side_b, "city": c.city}, {"is_home": "_home_b"}),
    )
    at_home = F.col("_home_a").isNotNull() | F.col("_home_b").isNotNull()
    return out.withColumn(name, (~at_home).cast("int")).drop("_home_a", "_home_b")
