"""Column bookkeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Of columns with the same name keep the last one, in its place."""
    last = {name: i for i, name in enumerate(df.columns)}
    by_position = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    kept = sorted(last.items(), key=lambda item: item[1])
    return by_position.select(*[by_position[f"c{i}"].alias(name) for name, i in kept])
