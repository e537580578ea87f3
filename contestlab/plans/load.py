"""All contest tables at once, typed and under current names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from contestlab.columns import CONTEST, ContestColumns
from contestlab.constants import TEAM_NAMES
from contestlab.operators.names import normalize_names
from contestlab.sources.tables import read_table


def load_tables(
    spark: SparkSession,
    paths: Mapping[str, str],
    names: Mapping[str, str] | DataFrame = TEAM_NAMES,
    fmt: str = "csv",
    c: ContestColumns = CONTEST,
) -> dict[str, DataFrame]:
    """Read the tables named in ``paths``.

    Names in pairings ("A vs B") are left to the operators that split them.
    """
    sides = ["batting_team", "bowling_team"]
    columns = {"matches": c.names, "deliveries": sides, "ball_by_ball": sides}
    tables = {t: read_table(spark, path, t, fmt) for t, path in paths.items()}
    return {t: normalize_names(df, columns.get(t, []), names) for t, df in tables.items()}
