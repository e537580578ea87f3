import pytest

from contestlab.operators.columns import dedupe_columns
from contestlab.operators.names import normalize_names, split_pair
from contestlab.operators.place import current_homes, home_table, with_neutral_flag
from contestlab.operators.rates import score_rows, team_score_averages
from tests.helpers import bag, keyed

NAMES = {"Old": "New", "Older": "New"}


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("Old", "x"), ("Older", "Old"), ("New", None), (None, "Olde")], "a string, b string"
    )


def test_unknown_names_and_null_stay(people):
    out = [tuple(r) for r in normalize_names(people, ["a", "b"], NAMES).collect()]
    assert out == [("New", "x"), ("New", "New"), ("New", None), (None, "Olde")]


def test_name_table_equals_name_map(spark, people):
    table = spark.createDataFrame(list(NAMES.items()), "old_name string, new_name string")
    by_table = normalize_names(people, ["a", "b"], table)
    assert by_table.columns == people.columns
    assert bag(by_table) == bag(normalize_names(people, ["a", "b"], NAMES))


def test_pair_without_separator(spark):
    df = spark.createDataFrame([("A vs B",), ("solo",), (None,)], "Team string")
    out = [(r.team_A, r.team_B) for r in split_pair(df).collect()]
    assert out == [("A", "B"), ("solo", None), (None, None)]


def test_pair_separator_is_plain_text(spark):
    df = spark.createDataFrame([("A.|.B",)], "Team string")
    assert split_pair(df, separator=".|.").first().team_B == "B"


def test_pair_names_before_and_after_the_split(spark):
    perf = spark.createDataFrame(
        [("Old vs B", 10.0, None), ("New vs B", 30.0, 5.0)],
        "Team string, First_Innings_Score double, Second_Innings_Score double",
    )
    after = keyed(team_score_averages(perf, NAMES), "Team")
    assert after == {("New",): (20.0, 5.0), ("B",): (20.0, 5.0)}
    before = keyed(team_score_averages(perf, NAMES, "before_split"), "Team")
    assert before == {("Old",): (10.0, None), ("New",): (30.0, 5.0), ("B",): (20.0, 5.0)}
    assert score_rows(perf, NAMES).count() == 4
    with pytest.raises(ValueError):
        score_rows(perf, NAMES, "never")


def test_last_of_equal_columns_stays(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    df = df.toDF("a", "b", "a", "c")
    out = dedupe_columns(df)
    assert out.columns == ["b", "a", "c"] and tuple(out.first()) == (2, 3, 4)


def test_neutral_ground(spark, matches):
    homes = current_homes(
        spark.createDataFrame(
            [("Old", "X"), ("Older", "X"), ("New", "Y"), ("B", "Z")], "team string, city string"
        ),
        NAMES,
    )
    assert homes.count() == 3
    rows = [
        dict(team1="New", team2="B", city="X"),
        dict(team1="B", team2="New", city="Y"),
        dict(team1="New", team2="B", city="Q"),
        dict(team1="New", team2="B", city=None),
        dict(team1="Homeless", team2="Other", city="X"),
    ]
    out = with_neutral_flag(matches(rows), homes)
    assert [r.neutral_venue for r in out.orderBy("match_id").collect()] == [0, 0, 1, 1, 1]


def test_default_homes_use_current_names(spark):
    teams = {r.team for r in home_table(spark).collect()}
    assert "Rising Pune Supergiants" in teams and "Deccan Chargers" not in teams
