import random
from collections import Counter

import pytest

from contestlab.operators.rates import (
    appearances,
    entity_rate,
    outcome_cells,
    overall_rate,
    pair_rate,
    pair_wins,
    place_rate,
    unordered_pair_rate,
    wins_within,
)
from tests.helpers import keyed


@pytest.fixture
def history(matches):
    rng = random.Random(7)
    teams = ["A", "B", "C", "D"]
    rows = []
    for _ in range(400):
        a, b = rng.choice(teams), rng.choice(teams)  # equal names are possible
        rows.append(
            dict(
                team1=a,
                team2=b,
                winner=rng.choice([a, b, None, "Z"]),  # Z takes no part
                season=rng.choice(["s1", "s2", "s3"]),
                venue=rng.choice(["v1", "v2"]),
                city=rng.choice(["c1", "c2", None]),
            )
        )
    return rows, matches(rows)


def rounded(won, played):
    return int(won / played * 1000 + 0.5 + 1e-9) / 1000


def test_pair_rate_is_ordered(history):
    rows, df = history
    played = Counter((r["team1"], r["team2"]) for r in rows)
    won = Counter((r["team1"], r["team2"]) for r in rows if r["winner"] == r["team1"])
    out = keyed(pair_rate(outcome_cells(df)), "team1", "team2")
    assert out == {k: (n, won[k], rounded(won[k], n)) for k, n in played.items()}
    assert keyed(pair_wins(outcome_cells(df)), "team1", "team2") == {
        k: (n,) for k, n in won.items()
    }


@pytest.mark.parametrize("by", ["season", "venue"])
def test_entity_rate_equals_join_of_counts(history, by):
    rows, df = history
    played = Counter((r[by], r[s]) for r in rows for s in ("team1", "team2"))
    won = Counter((r[by], r["winner"]) for r in rows if r["winner"])
    cells = outcome_cells(df, ["season", "venue"])
    out = keyed(entity_rate(cells, [by], by), by, "team")
    assert out == {k: (n, won[k], rounded(won[k], n)) for k, n in played.items()}
    assert sum(n for n, _, _ in out.values()) == 2 * len(rows)
    counts = keyed(appearances(cells, [by], "n"), by, "team")
    assert counts == {k: (n,) for k, n in played.items()}
    winners = keyed(wins_within(cells, [by], "n"), by, "team")
    assert winners == {
        k: (n,) for k, n in Counter((r[by], r["winner"]) for r in rows).items()
    }


def test_equal_sides_are_two_appearances_and_one_win(matches):
    df = matches([dict(team1="A", team2="A", winner="A", season="s")])
    out = keyed(entity_rate(outcome_cells(df, ["season"]), ["season"], "season"), "season", "team")
    assert out == {("s", "A"): (2, 1, 0.5)}


def test_unknown_group_has_no_wins(matches):
    df = matches([dict(team1="A", team2="B", winner="A", season=None)])
    out = keyed(entity_rate(outcome_cells(df, ["season"]), ["season"], "season"), "season", "team")
    assert out == {(None, "A"): (1, 0, 0.0), (None, "B"): (1, 0, 0.0)}


def test_request_rates_against_filters(history):
    rows, df = history
    cells = outcome_cells(df, ["city"])
    pairs = keyed(unordered_pair_rate(cells), "team", "opponent")
    overall = keyed(overall_rate(cells), "team")
    places = keyed(place_rate(cells, "city"), "city", "team")
    for a in "ABCD":
        mine = [r for r in rows if a in (r["team1"], r["team2"])]
        wins = sum(r["winner"] == a for r in rows)
        assert overall[(a,)][:2] == (len(mine), wins)
        for b in "ABCD":
            met = [r for r in mine if (r["team1"], r["team2"]) in ((a, b), (b, a))]
            won = sum(r["winner"] == a for r in met)
            assert pairs[(a, b)][:2] == (len(met), won)
            assert pairs[(a, b)][2] == pytest.approx(won / len(met))
        for city in ("c1", "c2"):
            there = [r for r in mine if r["city"] == city]
            assert places[(city, a)][:2] == (len(there), sum(r["winner"] == a for r in there))
