from contestlab.operators import describe
from tests.helpers import bag, keyed


def test_three_flag_groups(matches):
    rows = [
        dict(toss_winner="A", winner="A", toss_decision="bat", season="s1"),
        dict(toss_winner="A", winner="B", toss_decision="bat", season="s1"),
        dict(toss_winner="A", winner=None, toss_decision="bat", season="s2"),
    ]
    df = matches(rows, team1="A", team2="B")
    assert keyed(describe.draw_flag_counts(df), "toss_match_win") == {
        (True,): (1,),
        (False,): (1,),
        (None,): (1,),
    }
    assert describe.decision_flag_counts(df).count() == 3
    assert describe.season_flag_counts(df).count() == 3
    pivot = describe.season_flag_pivot(df)
    assert pivot.columns == ["season", "draw_winner_lost", "draw_winner_won"]
    assert keyed(pivot, "season") == {("s1",): (1, 1), ("s2",): (0, 0)}


def test_ties_at_the_last_rank(spark):
    rows = [(f"p{i:02d}", 1) for i in range(15)] + [("z", 9)]
    df = spark.createDataFrame(rows, "batter string, batsman_runs int")
    top = [r.batter for r in describe.top_batters(df.repartition(5)).collect()]
    assert top == ["z", *[f"p{i:02d}" for i in range(9)]]


def test_wins_are_in_order(matches):
    df = matches([dict(winner=w) for w in "BABCCB"] + [dict(winner=None)])
    out = [tuple(r) for r in describe.wins_by_team(df).collect()]
    assert out == [("B", 3), ("C", 2), (None, 1), ("A", 1)]


def test_sums_ignore_missing_runs(spark):
    rows = [(1.1, 4), (2.1, None), (17.2, 6)]
    df = spark.createDataFrame(rows, "ball_no double, runs_scored int")
    assert keyed(describe.runs_by_phase(df), "phase") == {
        ("Powerplay",): (4,),
        ("Death Overs",): (6,),
    }


def test_bowlers_count_real_wickets(spark):
    df = spark.createDataFrame(
        [("x", 1, "caught"), ("x", 1, None), ("y", 0, "caught"), ("y", 1, "lbw")],
        "bowler string, is_wicket int, dismissal_kind string",
    )
    assert bag(describe.top_bowlers(df)) == {("x", 1): 1, ("y", 1): 1}


def test_domains_are_sorted_without_null(matches):
    rows = [dict(team1="B", team2="A", city="y"), dict(team1="A", team2="C", city=None)]
    out = [tuple(r) for r in describe.domain_lists(matches(rows)).collect()]
    assert out == [("city", "y"), ("team", "A"), ("team", "B"), ("team", "C")]
