import pytest
from pyspark.sql import functions as F

from contestlab.constants import PHASES
from contestlab.functions.outcome import (
    draw_flag,
    draw_flag_int,
    draw_winner_is_a,
    first_side,
    is_wicket,
    label_side_a,
    rate,
)
from contestlab.functions.split import in_training, split_bucket
from contestlab.operators.describe import with_phase


def test_no_result_in_three_ways(matches):
    rows = [
        dict(team1="A", team2="B", toss_winner="A", winner="A"),
        dict(team1="A", team2="B", toss_winner="A", winner="B"),
        dict(team1="A", team2="B", toss_winner="A", winner=None),
        dict(team1="A", team2="B", toss_winner=None, winner=None),
    ]
    out = matches(rows).select(draw_flag(), draw_flag_int(), label_side_a(), draw_winner_is_a())
    assert [tuple(r) for r in out.collect()] == [
        (True, 1, 1, 1),
        (False, 0, 0, 1),
        (None, 0, 0, 1),
        (None, 0, 0, 0),
    ]


@pytest.mark.parametrize(
    "decision, drew, expected",
    [
        ("bat", "A", "A"),
        ("bat", "B", "B"),
        ("field", "A", "B"),
        ("field", "B", "A"),
        (None, "A", "B"),
        (None, "B", "A"),
        ("field", None, "A"),
        ("bat", None, None),
    ],
)
def test_first_side(matches, decision, drew, expected):
    df = matches([dict(team1="A", team2="B", toss_winner=drew, toss_decision=decision)])
    assert df.select(first_side()).first()[0] == expected


def test_phases(spark):
    balls = [0.1, 6.6, 7.1, 15.6, 16.1, None]
    df = spark.createDataFrame([(b,) for b in balls], "ball_no double")
    power, middle, death = PHASES
    assert [r.phase for r in with_phase(df).collect()] == [
        power,
        power,
        middle,
        middle,
        death,
        death,
    ]


def test_wicket_needs_flag_and_kind(spark):
    df = spark.createDataFrame(
        [(1, "bowled"), (1, None), (0, "bowled"), (None, "bowled")],
        "is_wicket int, dismissal_kind string",
    )
    assert df.where(is_wicket()).count() == 1


def test_rate_without_contests_is_null(spark):
    df = spark.createDataFrame([(1, 3), (0, 4), (0, 0)], "a int, b int")
    out = [r[0] for r in df.select(rate(F.col("a"), F.col("b"))).collect()]
    assert out == [0.333, 0.0, None]


def test_split_depends_on_the_key_alone(spark):
    df = spark.range(5000).withColumnRenamed("id", "match_id")
    flag = in_training("match_id").alias("t")
    one = {r.match_id: r.t for r in df.coalesce(1).select("match_id", flag).collect()}
    many = {r.match_id: r.t for r in df.repartition(13).select("match_id", flag).collect()}
    assert one == many
    assert 0.77 < sum(one.values()) / 5000 < 0.83
    buckets = {r[0] for r in df.select(split_bucket("match_id")).collect()}
    assert buckets == set(range(100))


def test_split_takes_several_keys_and_seeds(spark):
    df = spark.createDataFrame([("a", str(i)) for i in range(400)], "x string, y string")
    shares = [df.where(in_training("x", "y", seed=s)).count() / 400 for s in (1, 2)]
    assert all(0.7 < s < 0.9 for s in shares)
    differ = in_training("x", "y", seed=1) != in_training("x", "y", seed=2)
    assert df.where(differ).count() > 0
