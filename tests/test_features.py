import random

import pytest
from pyspark.sql import functions as F

from contestlab.functions.split import in_training
from contestlab.operators.rates import team_score_averages
from contestlab.plans.features import (
    AVERAGES,
    RATES,
    base_features,
    categorical,
    smart_features,
    training_rows,
)
from contestlab.plans.recommend import matchup_features
from tests.helpers import bag, physical


@pytest.fixture
def tables(spark, matches):
    rng = random.Random(11)
    teams = ["A", "B", "C", "D", "E"]
    rows = []
    for _ in range(300):
        a, b = rng.sample(teams, 2)
        rows.append(
            dict(
                team1=a,
                team2=b,
                winner=rng.choice([a, b, None]),
                season=rng.choice(["s1", "s2"]),
                venue=rng.choice(["v1", "v2", "v3"]),
                city=rng.choice(["c1", None]),
                toss_winner=rng.choice([a, b]),
                toss_decision=rng.choice(["bat", "field"]),
            )
        )
    perf = spark.createDataFrame(
        [(f"{a} vs {b}", float(rng.randrange(90, 200)), None) for a in "AB" for b in "CD"],
        "Team string, First_Innings_Score double, Second_Innings_Score double",
    )
    return rows, matches(rows), team_score_averages(perf)


def test_row_count_and_names(tables):
    rows, df, averages = tables
    out = smart_features(df, averages)
    assert out.count() == len(rows)
    assert len(set(out.columns)) == len(out.columns)
    assert set(df.columns + categorical() + AVERAGES + RATES + ["label"]) <= set(out.columns)
    for r in RATES:
        assert out.where(~F.col(r).between(0, 1) | F.col(r).isNull()).count() == 0
    assert base_features(df, averages).where("team1 = 'E' AND team1_avg_runs IS NULL").count() > 0


def test_shuffled_joins_give_the_same_table(tables):
    _, df, averages = tables
    columns = smart_features(df, averages).columns
    large = smart_features(df, averages, broadcast_bytes=0).select(columns)
    assert bag(large) == bag(smart_features(df, averages))
    assert physical(large).count("SortMergeJoin") >= 6


def test_training_rates_ignore_the_test_split(tables):
    _, df, averages = tables
    test = ~in_training("match_id")
    flipped = df.withColumn("winner", F.when(test, F.col("team1")).otherwise(F.col("winner")))
    one = smart_features(df, averages, mode="train_only").select("match_id", *RATES)
    two = smart_features(flipped, averages, mode="train_only").select("match_id", *RATES)
    assert bag(one) == bag(two)
    full = smart_features(flipped, averages).select("match_id", *RATES)
    assert bag(full) != bag(smart_features(df, averages).select("match_id", *RATES))
    with pytest.raises(ValueError):
        smart_features(df, averages, mode="test_only")


def test_no_history_gives_the_neutral_rate(spark, matches, tables):
    _, _, averages = tables
    history = matches(
        [
            dict(team1="A", team2="B", winner="A", city="c1"),
            dict(team1="B", team2="A", winner="A", city="c2"),
            dict(team1="B", team2="C", winner=None, city="c1"),
        ]
    )
    requests = spark.createDataFrame(
        [
            (1, "A", "B", "c1"),
            (2, "A", "C", "c9"),
            (3, "New", "A", "c1"),
            (4, "B", "A", None),
        ],
        "request_id bigint, team1 string, team2 string, city string",
    )
    out = matchup_features(requests, history, averages).orderBy("request_id").collect()
    assert [tuple(round(r[n], 3) for n in RATES) for r in out] == [
        (1.0, 1.0, 0.0, 1.0),
        (0.5, 1.0, 0.0, 0.5),
        (0.5, 0.5, 1.0, 0.5),
        (0.0, 0.0, 1.0, 0.5),
    ]
    assert out[2].team1_avg_runs is None


def test_training_averages_ignore_the_test_split(spark, tables):
    """Scores of test contests change no number of the table."""
    rng = random.Random(8)
    _, df, _ = tables
    names = df.select("match_id", "team1", "team2").collect()
    rows = [(r[0], f"{r[1]} vs {r[2]}", 100.0 + rng.random(), 90.0 + rng.random()) for r in names]
    perf = spark.createDataFrame(
        rows, "match_id bigint, Team string, First_Innings_Score double, Second_Innings_Score double"
    )
    test = ~in_training("match_id")
    changed = perf.withColumn(
        "First_Innings_Score", F.when(test, 0.0).otherwise(F.col("First_Innings_Score"))
    )

    def table(scores):
        found = team_score_averages(training_rows(scores))
        out = smart_features(df, found, mode="train_only").select("match_id", *AVERAGES)
        return bag(out.select("match_id", *[F.round(n, 9) for n in AVERAGES]))

    assert table(perf) == table(changed)
    assert bag(team_score_averages(perf)) != bag(team_score_averages(changed))
