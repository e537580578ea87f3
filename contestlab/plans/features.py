"""Per-contest feature tables.

Two scans of the contests make the smart table: one counts outcome cells, one
carries every row through the joins. All rates come from the cells.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestlab.columns import CONTEST, ContestColumns
from contestlab.constants import MODEL_TRAIN_PERCENT, NO_HISTORY_RATE, SPLIT_SEED
from contestlab.functions.outcome import draw_flag, first_side, label_side_a
from contestlab.functions.split import in_training
from contestlab.operators.attach import (
    BROADCAST_BYTES,
    Lookup,
    MeasuredTable,
    attach,
    measured,
    measured_at_once,
)
from contestlab.operators.rates import entity_rate, outcome_cells, pair_rate
from contestlab.sources.jobs import at_once
from contestlab.sources.scratch import written

AVERAGES = ["team1_avg_runs", "team2_avg_conceded"]
RATES = [
    "h2h_win_rate",
    "team1_season_win_rate",
    "team2_season_win_rate",
    "team1_venue_win_rate",
]

Table = DataFrame | MeasuredTable


def categorical(c: ContestColumns = CONTEST) -> list[str]:
    return [c.side_a, c.side_b, c.draw_winner, c.decision, "bat_first_team", c.season]


def with_outcomes(matches: DataFrame, c: ContestColumns = CONTEST) -> DataFrame:
    return matches.withColumns(
        {
            "toss_match_win": draw_flag(c),
            "label": label_side_a(c),
            "bat_first_team": first_side(c),
        }
    )


def score_lookups(averages: Table, c: ContestColumns = CONTEST) -> list[Lookup]:
    """First-innings mean of side a, second-innings mean of side b."""
    table = measured(averages)
    return [
        Lookup(table, {"Team": c.side_a}, {"avg_first_innings_score": "team1_avg_runs"}),
        Lookup(table, {"Team": c.side_b}, {"avg_second_innings_score": "team2_avg_conceded"}),
    ]


def pair_lookup(pairs: Table, c: ContestColumns = CONTEST) -> Lookup:
    on = {c.side_a: c.side_a, c.side_b: c.side_b}
    return Lookup(pairs, on, {"h2h_win_rate": "h2h_win_rate"})


def season_lookups(form: Table, c: ContestColumns = CONTEST) -> list[Lookup]:
    """The season's rate of both sides."""
    table = measured(form)
    sides = ((c.side_a, "team1_season_win_rate"), (c.side_b, "team2_season_win_rate"))
    return [
        Lookup(table, {c.season: c.season, "team": side}, {"season_win_rate": name})
        for side, name in sides
    ]


def venue_lookup(
    venues: Table,
    c: ContestColumns = CONTEST,
    side: str | None = None,
    name: str = "team1_venue_win_rate",
) -> Lookup:
    """The venue's rate of one side, the first by default."""
    return Lookup(venues, {c.venue: c.venue, "team": side or c.side_a}, {"venue_win_rate": name})


def base_features(
    matches: DataFrame,
    averages: Table,
    c: ContestColumns = CONTEST,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The contests with outcomes and the sides' score averages, which come
    from ``team_score_averages``. All names are expected to be normalised."""
    lookups = score_lookups(averages, c)
    return attach(with_outcomes(matches, c), *lookups, broadcast_bytes=broadcast_bytes)


def rate_tables(history: DataFrame, c: ContestColumns = CONTEST) -> dict[str, MeasuredTable]:
    """Pair, season and venue rates, from one scan of the contests."""
    cells = written(outcome_cells(history, [c.season, c.venue], c), "cells")
    return measured_at_once(
        {
            "pair": pair_rate(cells, c),
            "season": entity_rate(cells, [c.season], "season", c),
            "venue": entity_rate(cells, [c.venue], "venue", c),
        },
        # The keys that each table is grouped by.
        {"pair": [c.side_a, c.side_b], "season": [c.season, "team"], "venue": [c.venue, "team"]},
    )


def training_rows(
    rows: DataFrame,
    percent: int = MODEL_TRAIN_PERCENT,
    seed: int = SPLIT_SEED,
    c: ContestColumns = CONTEST,
) -> DataFrame:
    """Rows of the training split's contests: of the contests themselves, or of any
    table with their key. Membership is a hash of the key, so nothing is joined."""
    return rows.where(in_training(c.key, percent=percent, seed=seed))


def smart_features(
    matches: DataFrame,
    averages: Table,
    mode: str = "full",
    percent: int = MODEL_TRAIN_PERCENT,
    seed: int = SPLIT_SEED,
    c: ContestColumns = CONTEST,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Base features and the four rates.

    ``mode="full"`` counts every contest, those of the test split included.
    ``mode="train_only"`` counts the training split and gives sides without
    history there the neutral rate; ``averages`` should then be those of
    ``training_rows`` of the scores, so that no test contest is in any number.
    """
    if mode not in ("full", "train_only"):
        raise ValueError(f"unknown mode: {mode}")
    history = matches
    if mode == "train_only":
        history = training_rows(matches, percent, seed, c)
    made = at_once(
        matches.sparkSession,
        {"rates": partial(rate_tables, history, c), "averages": partial(measured, averages)},
    )
    rates = made["rates"]
    out = attach(
        with_outcomes(matches, c),
        *score_lookups(made["averages"], c),
        pair_lookup(rates["pair"], c),
        *season_lookups(rates["season"], c),
        venue_lookup(rates["venue"], c),
        broadcast_bytes=broadcast_bytes,
    )
    if mode == "train_only":
        out = out.withColumns({r: F.coalesce(r, F.lit(NO_HISTORY_RATE)) for r in RATES})
    return out
