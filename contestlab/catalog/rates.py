"""Historic rates and the feature tables made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contestlab.catalog import fixtures as fx
from contestlab.catalog.registry import registered
from contestlab.catalog.twins import train_bucket, trained_averages, twin
from contestlab.operators import rates
from contestlab.operators.attach import attach
from contestlab.plans import features as plans
from contestlab.plans import recommend


def _six_digits(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@registered(
    twin(
        """SELECT team AS "Team", first_score AS "First_Innings_Score",
                  second_score AS "Second_Innings_Score"
           FROM score_rows""",
        "score_rows",
    )
)
def score_rows_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.score_rows(fx.performance(spark, sf_dir), fx.NAMES)


_AVERAGES = """SELECT team AS "Team", round(avg_first, 6) AS avg_first_innings_score,
                      round(avg_second, 6) AS avg_second_innings_score
               FROM averages"""


@registered(twin(_AVERAGES, "averages"))
def team_score_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = rates.team_score_averages(fx.performance(spark, sf_dir), fx.NAMES)
    return _six_digits(table, "avg_first_innings_score", "avg_second_innings_score")


@registered(
    twin(
        _AVERAGES,
        "raw_perf",
        score_rows="""SELECT team1 AS team, first_score, second_score FROM raw_perf
                      UNION ALL SELECT team2, first_score, second_score FROM raw_perf""",
        averages="""SELECT team, avg(first_score) AS avg_first, avg(second_score) AS avg_second
                    FROM score_rows GROUP BY team""",
    )
)
def team_score_averages_before_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names looked up before the split, so former names stay."""
    table = rates.team_score_averages(fx.performance(spark, sf_dir), fx.NAMES, "before_split")
    return _six_digits(table, "avg_first_innings_score", "avg_second_innings_score")


@registered(twin("SELECT * FROM pair_played", "pair_played"))
def pair_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.pair_totals(rates.outcome_cells(fx.matches(spark, sf_dir)))


@registered(twin("SELECT * FROM pair_won", "pair_won"))
def pair_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.pair_wins(rates.outcome_cells(fx.matches(spark, sf_dir)))


@registered(twin("SELECT * FROM pair_rate", "pair_rate"))
def pair_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.pair_rate(rates.outcome_cells(fx.matches(spark, sf_dir)))


def _cells(spark: SparkSession, sf_dir: str, by: str) -> DataFrame:
    return rates.outcome_cells(fx.matches(spark, sf_dir), [by])


@registered(twin("SELECT * FROM season_won", "season_won"))
def season_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.wins_within(_cells(spark, sf_dir, "season"), ["season"], "season_wins")


@registered(twin("SELECT * FROM season_played", "season_played"))
def season_appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.appearances(_cells(spark, sf_dir, "season"), ["season"], "season_matches")


@registered(twin("SELECT * FROM season_rate", "season_rate"))
def season_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.entity_rate(_cells(spark, sf_dir, "season"), ["season"], "season")


@registered(twin("SELECT * FROM venue_won", "venue_won"))
def venue_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.wins_within(_cells(spark, sf_dir, "venue"), ["venue"], "venue_wins")


@registered(twin("SELECT * FROM venue_played", "venue_played"))
def venue_appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.appearances(_cells(spark, sf_dir, "venue"), ["venue"], "venue_matches")


@registered(twin("SELECT * FROM venue_rate", "venue_rate"))
def venue_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.entity_rate(_cells(spark, sf_dir, "venue"), ["venue"], "venue")


_ROUNDED_AVERAGES = """round(team1_avg_runs, 6) AS team1_avg_runs,
                       round(team2_avg_conceded, 6) AS team2_avg_conceded"""


@registered(
    twin(f"SELECT match_id, team1, team2, {_ROUNDED_AVERAGES} FROM base", "base")
)
def attach_score_avgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = rates.team_score_averages(fx.performance(spark, sf_dir), fx.NAMES)
    rows = attach(fx.matches(spark, sf_dir), *plans.score_lookups(averages))
    return _six_digits(rows.select("match_id", "team1", "team2", *plans.AVERAGES), *plans.AVERAGES)


@registered(twin("SELECT match_id, h2h_win_rate FROM smart", "smart"))
def attach_pair_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = fx.matches(spark, sf_dir)
    table = rates.pair_rate(rates.outcome_cells(matches))
    return attach(matches, plans.pair_lookup(table)).select("match_id", "h2h_win_rate")


@registered(
    twin("SELECT match_id, team1_season_win_rate, team2_season_win_rate FROM smart", "smart")
)
def attach_season_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = season_rate(spark, sf_dir)
    rows = attach(fx.matches(spark, sf_dir), *plans.season_lookups(form))
    return rows.select("match_id", "team1_season_win_rate", "team2_season_win_rate")


@registered(twin("SELECT match_id, team1_venue_win_rate FROM smart", "smart"))
def attach_venue_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = plans.venue_lookup(venue_rate(spark, sf_dir))
    rows = attach(fx.matches(spark, sf_dir), lookup)
    return rows.select("match_id", "team1_venue_win_rate")


_CATEGORIES = "match_id, team1, team2, toss_winner, toss_decision, bat_first_team, season, label"
_RATES = ", ".join(plans.RATES)


def _feature_columns(df: DataFrame, numbers: list[str]) -> DataFrame:
    rows = df.select("match_id", *plans.categorical(), "label", *numbers)
    return _six_digits(rows, *plans.AVERAGES)


@registered(twin(f"SELECT {_CATEGORIES}, {_ROUNDED_AVERAGES} FROM base", "base"))
def base_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    past = fx.history(spark, sf_dir)
    rows = plans.base_features(past.matches, past.averages)
    return _feature_columns(rows, plans.AVERAGES)


def smart_table(spark: SparkSession, sf_dir: str, mode: str = "full") -> DataFrame:
    """The smart feature table with all columns of the contests."""
    past = fx.history(spark, sf_dir, mode == "train_only")
    return plans.smart_features(past.matches, past.averages, mode=mode)


@registered(twin(f"SELECT {_CATEGORIES}, {_ROUNDED_AVERAGES}, {_RATES} FROM smart", "smart"))
def smart_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_columns(smart_table(spark, sf_dir), plans.AVERAGES + plans.RATES)


def _rate_of(won: str, played: str) -> str:
    return f"round(coalesce({won}, 0) / CAST({played} AS DOUBLE), 3)"


@registered(
    twin(
        f"""SELECT m.match_id, m.team1, m.team2, m.toss_winner, m.toss_decision,
                   m.bat_first_team, m.season, m.label, round(a.avg_first, 6) AS team1_avg_runs,
                   round(b.avg_second, 6) AS team2_avg_conceded,
                   coalesce({_rate_of('p.won', 'p.played')}, 0.5) AS h2h_win_rate,
                   coalesce({_rate_of('sw1.won', 's1.played')}, 0.5) AS team1_season_win_rate,
                   coalesce({_rate_of('sw2.won', 's2.played')}, 0.5) AS team2_season_win_rate,
                   coalesce({_rate_of('vw.won', 'v.played')}, 0.5) AS team1_venue_win_rate
            FROM flagged m
            LEFT JOIN averages a ON a.team = m.team1
            LEFT JOIN averages b ON b.team = m.team2
            LEFT JOIN pairs p ON p.team1 = m.team1 AND p.team2 = m.team2
            LEFT JOIN season_n s1 ON s1.season = m.season AND s1.team = m.team1
            LEFT JOIN season_w sw1 ON sw1.season = m.season AND sw1.team = m.team1
            LEFT JOIN season_n s2 ON s2.season = m.season AND s2.team = m.team2
            LEFT JOIN season_w sw2 ON sw2.season = m.season AND sw2.team = m.team2
            LEFT JOIN venue_n v ON v.venue = m.venue AND v.team = m.team1
            LEFT JOIN venue_w vw ON vw.venue = m.venue AND vw.team = m.team1""",
        "flagged",
        "contests",
        "name_map",
        **trained_averages(),
        trained=f"SELECT * FROM matches WHERE {train_bucket('match_id')} < 80",
        pairs="""SELECT team1, team2, count(*) AS played,
                        count(CASE WHEN winner = team1 THEN 1 END) AS won
                 FROM trained GROUP BY team1, team2""",
        sides="""SELECT season, venue, team1 AS team FROM trained
                 UNION ALL SELECT season, venue, team2 FROM trained""",
        season_n="SELECT season, team, count(*) AS played FROM sides GROUP BY season, team",
        season_w="""SELECT season, winner AS team, count(*) AS won
                    FROM trained GROUP BY season, winner""",
        venue_n="SELECT venue, team, count(*) AS played FROM sides GROUP BY venue, team",
        venue_w="""SELECT venue, winner AS team, count(*) AS won
                   FROM trained GROUP BY venue, winner""",
    )
)
def smart_features_train_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = smart_table(spark, sf_dir, "train_only")
    return _feature_columns(rows, plans.AVERAGES + plans.RATES)


@registered(twin("SELECT * FROM requests", "requests"))
def request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.requests(spark, sf_dir)


MATCHUPS = """SELECT r.request_id, r.city, r.venue, r.team1, r.team2, r.neutral,
           r.draw_winner_is_team1,
           round(a.avg_first, 6) AS team1_avg_runs,
           round(b.avg_second, 6) AS team2_avg_conceded,
           round(coalesce(h.won / CAST(h.played AS DOUBLE), 0.5), 6) AS h2h_win_rate,
           round(coalesce(coalesce(w1.won, 0) / CAST(o1.played AS DOUBLE), 0.5), 6)
               AS team1_season_win_rate,
           round(coalesce(coalesce(w2.won, 0) / CAST(o2.played AS DOUBLE), 0.5), 6)
               AS team2_season_win_rate,
           round(coalesce(c.won / CAST(c.played AS DOUBLE), 0.5), 6)
               AS team1_venue_win_rate
    FROM requests r
    LEFT JOIN averages a ON a.team = r.team1
    LEFT JOIN averages b ON b.team = r.team2
    LEFT JOIN pairs h ON h.team = r.team1 AND h.opponent = r.team2
    LEFT JOIN played o1 ON o1.team = r.team1
    LEFT JOIN played o2 ON o2.team = r.team2
    LEFT JOIN won w1 ON w1.team = r.team1
    LEFT JOIN won w2 ON w2.team = r.team2
    LEFT JOIN city_rate c ON c.city = r.city AND c.team = r.team1"""

MATCHUP_TABLES = dict(
    views="""SELECT team1 AS team, team2 AS opponent, city, winner FROM matches
             UNION ALL
             SELECT team2, team1, city, winner FROM matches WHERE team1 <> team2""",
    pairs="""SELECT team, opponent, count(*) AS played,
                    count(CASE WHEN winner = team THEN 1 END) AS won
             FROM views GROUP BY team, opponent""",
    played="SELECT team, count(*) AS played FROM views GROUP BY team",
    won="SELECT winner AS team, count(*) AS won FROM matches GROUP BY winner",
    city_rate="""SELECT city, team, count(*) AS played,
                        count(CASE WHEN winner = team THEN 1 END) AS won
                 FROM views GROUP BY city, team""",
)


@registered(twin(MATCHUPS, "requests", "averages", "matches", **MATCHUP_TABLES))
def matchup_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    past, asked = fx.history(spark, sf_dir), fx.requests(spark, sf_dir)
    rows = recommend.matchup_features(asked, past.matches, past.averages)
    return _six_digits(rows, *plans.AVERAGES, *plans.RATES)
