"""From text files to recommendations, by the public functions alone."""

import random

import pytest

from contestlab.columns import ContestColumns
from contestlab.constants import TEAM_NAMES
from contestlab.operators import describe
from contestlab.operators.attach import measured
from contestlab.operators.place import home_table, with_neutral_flag
from contestlab.operators.rates import team_score_averages
from contestlab.plans import features, load, models, recommend

TEAMS = ["Mumbai Indians", "Deccan Chargers", "Sunrisers Hyderabad", "Kings XI Punjab"]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    rng = random.Random(2)
    folder = tmp_path_factory.mktemp("tables")
    matches = ["id,season,city,venue,team1,team2,toss_winner,toss_decision,winner,player_of_match"]
    perf = ["Teams,First_Innings_Score,Second_Innings_Score"]
    for i in range(240):
        a, b = rng.sample(TEAMS, 2)
        toss, won = rng.choice([a, b]), rng.choice([a, a, b, ""])
        city = rng.choice(["Mumbai", "Hyderabad", ""])
        decision = rng.choice(["bat", "field"])
        matches.append(
            f"{i},{2008 + i % 5},{city},V{i % 4},{a},{b},{toss},{decision},{won},P{i % 9}"
        )
        perf.append(f"{a} vs {b},{rng.randrange(120, 200)},{rng.choice(['NA', 150])}")
    deliveries = ["batter,bowler,batting_team,bowling_team,batsman_runs,is_wicket,dismissal_kind"]
    deliveries += [
        f"B{i % 12},W{i % 12},{TEAMS[1]},{TEAMS[0]},{i % 5},{i % 2},lbw" for i in range(99)
    ]
    balls = [" Batting Team,Bowling Team ,Ball No,Runs Scored"]
    balls += [f"{TEAMS[3]},{TEAMS[0]},{i % 20}.{i % 6},{i % 4}" for i in range(99)]
    texts = dict(
        matches=matches, team_performance=perf, deliveries=deliveries, ball_by_ball=balls
    )
    paths = {}
    for name, lines in texts.items():
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
        paths[name] = str(folder / f"{name}.csv")
    return paths


def test_from_text_to_recommendation(spark, files):
    c = ContestColumns(key="id")
    tables = load.load_tables(spark, files, c=c)
    matches = tables["matches"]
    assert matches.where("team1 = 'Deccan Chargers' OR winner = 'Kings XI Punjab'").count() == 0
    assert describe.draw_flag_counts(matches, c).count() == 3
    assert describe.top_batters(tables["deliveries"]).count() == 10
    assert describe.runs_by_phase(tables["ball_by_ball"]).count() == 3
    assert describe.season_flag_pivot(matches, c).count() == 5

    averages = measured(team_score_averages(tables["team_performance"], TEAM_NAMES))
    assert averages.rows == 3  # two of the four names are one team
    smart = features.smart_features(matches, averages, c=c)
    assert smart.count() == 240
    table = models.compare_models(smart, trees=5, boosting_rounds=3, c=c)
    assert table.count() == 2 * 5 * 5

    flagged = with_neutral_flag(matches, home_table(spark), c)
    assert {r[0] for r in flagged.select("neutral_venue").distinct().collect()} == {0, 1}

    answers = ["'Yes' AS neutral", "'Team 1' AS toss_winner"]
    form = matches.selectExpr("id", "city", "venue", "team1", "team2", *answers)
    asked = recommend.matchup_features(recommend.request_rows(form), matches, averages, c)
    model = recommend.fit_request_model(smart, c=c)
    out = recommend.score_requests(asked, model, c=c)
    assert out.count() == 240
    assert out.where("recommendation NOT IN ('FIELD', 'BAT') OR probability IS NULL").count() == 0
