"""Descriptive aggregates. Every one is a partial aggregate before its
shuffle, so a key with very many rows leaves each task as one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contestlab.columns import CONTEST, ContestColumns
from contestlab.functions.outcome import draw_flag, is_wicket, over_number, over_phase

TOP = 10


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def ranked(df: DataFrame, measure: str, key: str) -> DataFrame:
    """Descending by ``measure``; ties in the order of the key."""
    return df.orderBy(F.desc(measure), F.asc_nulls_first(key))


def top_counts(df: DataFrame, key: str, k: int = TOP) -> DataFrame:
    return ranked(count_by(df, key), "count", key).limit(k)


def top_sums(df: DataFrame, key: str, value: str, name: str, k: int = TOP) -> DataFrame:
    return ranked(df.groupBy(key).agg(F.sum(value).alias(name)), name, key).limit(k)


def with_draw_flag(matches: DataFrame, c: ContestColumns = CONTEST) -> DataFrame:
    return matches.withColumn("toss_match_win", draw_flag(c))


def draw_flag_counts(matches: DataFrame, c: ContestColumns = CONTEST) -> DataFrame:
    """Contests by flag: true, false, and NULL for no result."""
    return count_by(with_draw_flag(matches, c), "toss_match_win")


def decision_flag_counts(matches: DataFrame, c: ContestColumns = CONTEST) -> DataFrame:
    return count_by(with_draw_flag(matches, c), c.decision, "toss_match_win")


def wins_by_team(matches: DataFrame, c: ContestColumns = CONTEST) -> DataFrame:
    return ranked(count_by(matches, c.winner), "count", c.winner)


def top_venues(matches: DataFrame, k: int = TOP, c: ContestColumns = CONTEST) -> DataFrame:
    return top_counts(matches, c.venue, k)


def top_players(matches: DataFrame, k: int = TOP, c: ContestColumns = CONTEST) -> DataFrame:
    return top_counts(matches, c.player, k)


def top_batters(
    deliveries: DataFrame, k: int = TOP, batter: str = "batter", runs: str = "batsman_runs"
) -> DataFrame:
    return top_sums(deliveries, batter, runs, "total_runs", k)


def wickets(deliveries: DataFrame) -> DataFrame:
    return deliveries.where(is_wicket())


def top_bowlers(deliveries: DataFrame, k: int = TOP, bowler: str = "bowler") -> DataFrame:
    return top_counts(wickets(deliveries), bowler, k)


def with_phase(balls: DataFrame, ball: str = "ball_no") -> DataFrame:
    return balls.withColumn("over", over_number(ball)).withColumn("phase", over_phase("over"))


def runs_by_phase(
    balls: DataFrame, ball: str = "ball_no", runs: str = "runs_scored"
) -> DataFrame:
    return with_phase(balls, ball).groupBy("phase").agg(F.sum(runs).alias("total_runs"))


def season_flag_counts(matches: DataFrame, c: ContestColumns = CONTEST) -> DataFrame:
    return count_by(with_draw_flag(matches, c), c.season, "toss_match_win")


def season_flag_pivot(matches: DataFrame, c: ContestColumns = CONTEST) -> DataFrame:
    """One row per season and a column per flag value; contests without a
    result are in neither column, but their season keeps its row."""
    flag = F.col("toss_match_win")
    return (
        with_draw_flag(matches, c)
        .groupBy(c.season)
        .agg(
            F.count_if(~flag).alias("draw_winner_lost"),
            F.count_if(flag).alias("draw_winner_won"),
        )
    )


def domain_values(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Sorted distinct values of each domain, as (domain, value).

    A domain may draw on several columns. One scan serves all domains: each row
    gives one value per column, and a task sends each of a domain's values once.
    """
    cells: list[Column] = [
        F.struct(F.lit(name).alias("domain"), F.col(c).alias("value"))
        for name, cols in domains.items()
        for c in cols
    ]
    return (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("domain", "value")
    )


def domain_lists(matches: DataFrame, c: ContestColumns = CONTEST) -> DataFrame:
    return domain_values(matches, {"city": [c.city], "team": [c.side_a, c.side_b]})
