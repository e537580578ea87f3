"""Typed scans of contest tables kept as text or as Parquet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns that are not text. Every other column stays as it is.
TYPES: dict[str, dict[str, str]] = {
    "matches": {"match_id": "bigint"},
    "deliveries": {
        "match_id": "bigint",
        "inning": "int",
        "batsman_runs": "int",
        "is_wicket": "int",
    },
    "ball_by_ball": {"ball_no": "double", "runs_scored": "int"},
    "team_performance": {
        "First_Innings_Score": "double",
        "Second_Innings_Score": "double",
    },
    "team_info": {},
    "players_info": {},
}

# Columns known under two names.
RENAMED: dict[str, dict[str, str]] = {"team_performance": {"Teams": "Team"}}

# Tables whose headers are tidied first.
UNTIDY = {"ball_by_ball"}

_WHOLE = {"int", "bigint"}


def _parsed(name: str, kind: str) -> Column:
    text = F.col(f"`{name}`")
    if kind in _WHOLE:
        # "4.0" is a whole number written as a decimal, "4.5" is none; longs stay
        # exact (a cast of the text itself would cut "4.5").
        number = text.try_cast("double")
        plain = F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text.try_cast("bigint"))
        decimal = F.when(number == F.floor(number), number.try_cast("bigint"))
        return F.coalesce(plain, decimal).try_cast(kind)
    return text.try_cast(kind)


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Give columns their types. A token that does not parse becomes NULL,
    with ANSI mode left on. A column that is not text keeps its type if it is
    the right one, so filters on it reach the scan."""
    columns = []
    for name, present in df.dtypes:
        column = F.col(f"`{name}`")
        wanted = types.get(name, present)
        if wanted != present:
            column = _parsed(name, wanted) if present == "string" else column.try_cast(wanted)
        columns.append(column.alias(name))
    return df.select(*columns)


def clean_headers(df: DataFrame) -> DataFrame:
    """Trimmed, lower-case headers with underscores for spaces."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def conform(df: DataFrame, table: str) -> DataFrame:
    """A table of text, or of other types, with the headers and types of
    ``table``."""
    if table in UNTIDY:
        df = clean_headers(df)
    for old, new in RENAMED.get(table, {}).items():
        df = df.withColumnRenamed(old, new)
    return typed(df, TYPES[table])


def read_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """CSV with a header, every column as text, columns known by name.

    Only the header line is read up front; nothing is inferred. Parts whose
    header has other columns fail instead of shifting values.
    """
    reader = spark.read.option("header", True).options(**options)
    names = reader.csv(path).schema
    return reader.schema(names).option("enforceSchema", False).csv(path)


def read_table(
    spark: SparkSession, path: str, table: str, fmt: str = "csv", **options: str
) -> DataFrame:
    """One of the tables in ``TYPES``, typed. ``fmt`` is "csv", or any format
    Spark reads that carries its own schema, such as "parquet"."""
    if fmt == "csv":
        df = read_csv(spark, path, **options)
    else:
        df = spark.read.format(fmt).options(**options).load(path)
    return conform(df, table)
