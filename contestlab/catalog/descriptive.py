"""Sources, scalar columns and descriptive aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contestlab.catalog import fixtures as fx
from contestlab.catalog.registry import registered
from contestlab.catalog.twins import twin
from contestlab.functions.outcome import (
    draw_flag,
    draw_flag_int,
    draw_winner_is_a,
    first_side,
    label_side_a,
)
from contestlab.operators import describe
from contestlab.operators.columns import dedupe_columns
from contestlab.operators.names import normalize_names, split_pair
from contestlab.operators.place import current_homes, with_neutral_flag
from contestlab.sources.scratch import scratch_path
from contestlab.sources.tables import conform, read_table

SIDES = ["batting_team", "bowling_team"]


@registered(
    twin("SELECT match_id, team1, team2, toss_winner, winner FROM matches", "matches"),
    name="normalize_names",
)
def normalize_names_by_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.matches(spark, sf_dir).select("match_id", "team1", "team2", "toss_winner", "winner")


@registered(twin("SELECT match_id, team1, team2, toss_winner, winner FROM matches", "matches"))
def normalize_names_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["team1", "team2", "toss_winner", "winner"]
    raw = fx.raw_matches(spark, sf_dir).select("match_id", *columns)
    return normalize_names(raw, columns, fx.name_table(spark, sf_dir))


@registered(
    twin(
        """SELECT d.match_id, d.inning, coalesce(a.new_name, d.batting_team) AS batting_team,
                  coalesce(b.new_name, d.bowling_team) AS bowling_team, d.batter, d.bowler
           FROM deliveries d
           LEFT JOIN name_map a ON a.old_name = d.batting_team
           LEFT JOIN name_map b ON b.old_name = d.bowling_team""",
        "deliveries",
        "name_map",
    )
)
def normalize_delivery_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize_names(fx.deliveries(spark, sf_dir), SIDES, fx.NAMES)
    return rows.select("match_id", "inning", *SIDES, "batter", "bowler")


@registered(
    twin(
        """SELECT coalesce(a.new_name, batting_team) AS batting_team,
                  coalesce(b.new_name, bowling_team) AS bowling_team, ball_no, runs_scored
           FROM balls
           LEFT JOIN name_map a ON a.old_name = batting_team
           LEFT JOIN name_map b ON b.old_name = bowling_team""",
        "balls",
        "name_map",
    ),
    name="clean_headers",
)
def clean_ball_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    balls = conform(fx.raw_balls(spark, sf_dir), "ball_by_ball")
    return normalize_names(balls, SIDES, fx.NAMES)


@registered(
    twin(
        """SELECT match_id, inning, batter, bowler, dismissal_kind,
                  CASE WHEN bowler <> 'Brand#1' THEN batsman_runs END AS batsman_runs,
                  CASE WHEN batsman_runs <> 6 THEN is_wicket END AS is_wicket
           FROM deliveries""",
        "deliveries",
    )
)
def typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with unusable tokens, written as CSV and read back with types."""
    runs = F.col("batsman_runs")
    text = fx.player_deliveries(spark, sf_dir).select(
        "match_id",
        "inning",
        "batter",
        "bowler",
        F.when(F.col("bowler") == "Brand#1", "NA")
        .when(runs == "4", "4.0")
        .otherwise(runs)
        .alias("batsman_runs"),
        F.when(runs == "6", "NA").otherwise(F.col("is_wicket")).alias("is_wicket"),
        "dismissal_kind",
    )
    path = scratch_path(spark, "deliveries-csv")
    text.write.option("header", True).csv(path)
    return read_table(spark, path, "deliveries")


@registered(
    twin("SELECT match_id, toss_winner = winner AS toss_match_win FROM matches", "matches"),
    name="draw_flag",
)
def draw_flag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.matches(spark, sf_dir).select("match_id", draw_flag().alias("toss_match_win"))


@registered(
    twin(
        """SELECT match_id, CASE WHEN toss_winner = winner THEN 1 ELSE 0 END AS toss_win_int
           FROM matches""",
        "matches",
    ),
    name="draw_flag_int",
)
def draw_flag_int_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.matches(spark, sf_dir).select("match_id", draw_flag_int().alias("toss_win_int"))


@registered(
    twin("SELECT match_id, label FROM flagged", "flagged"),
    name="label_side_a",
)
def label_side_a_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.matches(spark, sf_dir).select("match_id", label_side_a().alias("label"))


@registered(
    twin("SELECT match_id, bat_first_team FROM flagged", "flagged"),
    name="first_side",
)
def first_side_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.matches(spark, sf_dir).select("match_id", first_side().alias("bat_first_team"))


@registered(
    twin(
        """SELECT match_id, CASE WHEN toss_winner = team1 THEN 1 ELSE 0 END
                  AS draw_winner_is_team1
           FROM matches""",
        "matches",
    ),
    name="draw_winner_is_a",
)
def draw_winner_is_a_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = draw_winner_is_a().alias("draw_winner_is_team1")
    return fx.matches(spark, sf_dir).select("match_id", flag)


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(fx.player_deliveries(spark, sf_dir), "deliveries")


def _balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(fx.raw_ball_scores(spark, sf_dir), "ball_by_ball")


@registered(
    twin(
        """SELECT match_id, inning, bowler, dismissal_kind FROM deliveries
           WHERE is_wicket = 1 AND dismissal_kind IS NOT NULL""",
        "deliveries",
    )
)
def wicket_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = describe.wickets(_deliveries(spark, sf_dir))
    return rows.select("match_id", "inning", "bowler", "dismissal_kind")


@registered(
    twin('SELECT ball_no, runs_scored, over_no AS "over", phase FROM phased', "phased")
)
def over_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.with_phase(_balls(spark, sf_dir))


@registered(
    twin(
        """SELECT team1 || ' vs ' || team2 AS "Team", team1 AS "team_A", team2 AS "team_B",
                  first_score AS "First_Innings_Score"
           FROM raw_perf""",
        "raw_perf",
    ),
    name="split_pair",
)
def split_pair_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_pair(fx.performance(spark, sf_dir)).drop("match_id", "Second_Innings_Score")


@registered(
    twin(
        "SELECT toss_match_win, count(*) AS count FROM flagged GROUP BY toss_match_win", "flagged"
    )
)
def draw_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.draw_flag_counts(fx.matches(spark, sf_dir))


@registered(
    twin(
        """SELECT toss_decision, toss_match_win, count(*) AS count
           FROM flagged GROUP BY toss_decision, toss_match_win""",
        "flagged",
    )
)
def decision_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.decision_flag_counts(fx.matches(spark, sf_dir))


@registered(
    twin(
        "SELECT winner, count(*) AS count FROM matches GROUP BY winner ORDER BY count DESC, winner",
        "matches",
    )
)
def wins_by_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.wins_by_team(fx.matches(spark, sf_dir))


def _top(select: str, rows: str, key: str, measure: str) -> str:
    return twin(
        f"{select} GROUP BY {key} ORDER BY {measure} DESC, {key} NULLS FIRST LIMIT 10", rows
    )


@registered(_top("SELECT venue, count(*) AS count FROM matches", "matches", "venue", "count"))
def top_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.top_venues(fx.matches(spark, sf_dir))


@registered(
    _top(
        "SELECT batter, CAST(sum(batsman_runs) AS BIGINT) AS total_runs FROM deliveries",
        "deliveries",
        "batter",
        "total_runs",
    )
)
def top_batters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.top_batters(_deliveries(spark, sf_dir))


@registered(
    _top(
        """SELECT bowler, count(*) AS count FROM deliveries
           WHERE is_wicket = 1 AND dismissal_kind IS NOT NULL""",
        "deliveries",
        "bowler",
        "count",
    )
)
def top_bowlers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.top_bowlers(_deliveries(spark, sf_dir))


@registered(
    _top(
        "SELECT player_of_match, count(*) AS count FROM matches",
        "matches",
        "player_of_match",
        "count",
    )
)
def top_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.top_players(fx.matches(spark, sf_dir))


@registered(
    twin(
        """SELECT phase, CAST(sum(runs_scored) AS BIGINT) AS total_runs
           FROM phased GROUP BY phase""",
        "phased",
    )
)
def runs_by_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.runs_by_phase(_balls(spark, sf_dir))


@registered(
    twin(
        """SELECT season, toss_match_win, count(*) AS count
           FROM flagged GROUP BY season, toss_match_win""",
        "flagged",
    )
)
def season_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.season_flag_counts(fx.matches(spark, sf_dir))


@registered(
    twin(
        """SELECT season,
                  count(CASE WHEN NOT toss_match_win THEN 1 END) AS draw_winner_lost,
                  count(CASE WHEN toss_match_win THEN 1 END) AS draw_winner_won
           FROM flagged GROUP BY season""",
        "flagged",
    )
)
def season_flag_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.season_flag_pivot(fx.matches(spark, sf_dir))


@registered(
    twin(
        """SELECT 'city' AS domain, city AS value FROM matches WHERE city IS NOT NULL
           UNION SELECT 'team', team1 FROM matches WHERE team1 IS NOT NULL
           UNION SELECT 'team', team2 FROM matches WHERE team2 IS NOT NULL""",
        "matches",
    )
)
def domain_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.domain_lists(fx.matches(spark, sf_dir))


@registered(
    twin(
        """SELECT m.match_id,
                  CASE WHEN a.city IS NULL AND b.city IS NULL THEN 1 ELSE 0 END AS neutral_venue
           FROM matches m
           LEFT JOIN homes a ON a.team = m.team1 AND a.city = m.city
           LEFT JOIN homes b ON b.team = m.team2 AND b.city = m.city""",
        "matches",
        "homes",
    )
)
def neutral_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    homes = current_homes(fx.homes(spark, sf_dir), fx.NAMES)
    flagged = with_neutral_flag(fx.matches(spark, sf_dir), homes)
    return flagged.select("match_id", "neutral_venue")


@registered(
    twin(
        """SELECT m.match_id, m.toss_winner AS winner, m.season
           FROM matches m""",
        "matches",
    ),
    name="dedupe_columns",
)
def dedupe_columns_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns named winner, of which the last one stays."""
    rows = fx.matches(spark, sf_dir).select(
        "match_id", "winner", F.col("toss_winner").alias("winner"), "season"
    )
    return dedupe_columns(rows)
