"""Historic rates.

The raw contests are scanned once: ``outcome_cells`` counts them per distinct
outcome, and each rate sums those counts. The step that makes one row per side
so works on the counts and not on the contests.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contestlab.columns import CONTEST, ContestColumns
from contestlab.functions.outcome import rate
from contestlab.operators.names import normalize_names, split_pair

COUNT = "contests"


def _none() -> Column:
    return F.lit(0).cast("bigint")


def outcome_cells(
    matches: DataFrame, by: Sequence[str] = (), c: ContestColumns = CONTEST
) -> DataFrame:
    """Number of contests per group, pair of sides and winner."""
    return matches.groupBy(*by, c.side_a, c.side_b, c.winner).agg(F.count("*").alias(COUNT))


def _known(*names: str) -> Column:
    known = F.lit(True)
    for n in names:
        known = known & F.col(n).isNotNull()
    return known


def pair_rate(cells: DataFrame, c: ContestColumns = CONTEST) -> DataFrame:
    """Share of the contests of the ordered pair that its first side won."""
    won = _known(c.side_a, c.side_b) & (F.col(c.winner) == F.col(c.side_a))
    return (
        cells.groupBy(c.side_a, c.side_b)
        .agg(
            F.sum(COUNT).alias("h2h_total_matches"),
            F.sum(F.when(won, F.col(COUNT)).otherwise(_none())).alias("h2h_team1_wins"),
        )
        .withColumn("h2h_win_rate", rate(F.col("h2h_team1_wins"), F.col("h2h_total_matches")))
    )


def pair_totals(cells: DataFrame, c: ContestColumns = CONTEST) -> DataFrame:
    return pair_rate(cells, c).select(c.side_a, c.side_b, "h2h_total_matches")


def pair_wins(cells: DataFrame, c: ContestColumns = CONTEST) -> DataFrame:
    """Only pairs that their first side has won."""
    return (
        pair_rate(cells, c)
        .where(F.col("h2h_team1_wins") > 0)
        .select(c.side_a, c.side_b, "h2h_team1_wins")
    )


def wins_within(
    cells: DataFrame, by: Sequence[str], name: str, c: ContestColumns = CONTEST
) -> DataFrame:
    """Contests won per group and team; no result shows as team NULL."""
    return cells.groupBy(*by, F.col(c.winner).alias("team")).agg(F.sum(COUNT).alias(name))


def _role(by: Sequence[str], team: str, played: Column, won: Column) -> Column:
    return F.struct(
        *[F.col(b).alias(b) for b in by],
        F.col(team).alias("team"),
        played.alias("played"),
        won.alias("won"),
    )


def _team_counts(
    cells: DataFrame,
    by: Sequence[str],
    c: ContestColumns,
    equal_names_once: bool = False,
    winner_takes_part: bool = False,
) -> DataFrame:
    """Contests played and won per group and team.

    ``equal_names_once``: a contest whose sides bear the same name is one
    appearance and not two. ``winner_takes_part``: a winner that is neither
    side gets no credit.
    """
    a, b, winner, n = F.col(c.side_a), F.col(c.side_b), F.col(c.winner), F.col(COUNT)
    again = a.eqNullSafe(b) if equal_names_once else F.lit(False)
    counts = _known(*by, c.winner)
    if winner_takes_part:
        counts = counts & (winner.eqNullSafe(a) | winner.eqNullSafe(b))
    roles = F.array(
        _role(by, c.side_a, n, _none()),
        _role(by, c.side_b, F.when(again, _none()).otherwise(n), _none()),
        _role(by, c.winner, _none(), F.when(counts, n).otherwise(_none())),
    )
    return (
        cells.select(F.inline(roles))
        .groupBy(*by, "team")
        .agg(F.sum("played").alias("played"), F.sum("won").alias("won"))
        .where(F.col("played") > 0)
    )


def entity_rate(
    cells: DataFrame, by: Sequence[str], prefix: str, c: ContestColumns = CONTEST
) -> DataFrame:
    """Appearances, wins and their rate per group and team.

    A contest is two appearances, also when both sides bear the same name, and
    one win, credited to its winner.
    """
    return _team_counts(cells, by, c).select(
        *by,
        "team",
        F.col("played").alias(f"{prefix}_matches"),
        F.col("won").alias(f"{prefix}_wins"),
        rate(F.col("won"), F.col("played")).alias(f"{prefix}_win_rate"),
    )


def appearances(
    cells: DataFrame, by: Sequence[str], name: str, c: ContestColumns = CONTEST
) -> DataFrame:
    """Appearances per group and team, on either side."""
    return _team_counts(cells, by, c).select(*by, "team", F.col("played").alias(name))


def overall_rate(cells: DataFrame, c: ContestColumns = CONTEST) -> DataFrame:
    """Unrounded rate per team over all its contests, for requests."""
    counts = _team_counts(cells, [], c, equal_names_once=True)
    return counts.withColumn("rate", rate(F.col("won"), F.col("played"), None))


def place_rate(cells: DataFrame, place: str, c: ContestColumns = CONTEST) -> DataFrame:
    """Unrounded rate per place and team, for requests."""
    counts = _team_counts(cells, [place], c, equal_names_once=True, winner_takes_part=True)
    return counts.withColumn("rate", rate(F.col("won"), F.col("played"), None))


def unordered_pair_rate(cells: DataFrame, c: ContestColumns = CONTEST) -> DataFrame:
    """For (team, opponent): contests in either order and the team's wins in
    them, unrounded, for requests."""
    n = F.col(COUNT)
    again = F.col(c.side_a).eqNullSafe(F.col(c.side_b))

    def seen_by(team: str, opponent: str, played: Column) -> Column:
        won = F.when(F.col(c.winner) == F.col(team), played).otherwise(_none())
        return F.struct(
            F.col(team).alias("team"),
            F.col(opponent).alias("opponent"),
            played.alias("played"),
            won.alias("won"),
        )

    views = F.array(
        seen_by(c.side_a, c.side_b, n),
        seen_by(c.side_b, c.side_a, F.when(again, _none()).otherwise(n)),
    )
    return (
        cells.select(F.inline(views))
        .groupBy("team", "opponent")
        .agg(F.sum("played").alias("played"), F.sum("won").alias("won"))
        .withColumn("rate", rate(F.col("won"), F.col("played"), None))
    )


def score_rows(
    perf: DataFrame,
    names: Mapping[str, str] | DataFrame | None = None,
    normalize_pairs: str = "after_split",
    team: str = "Team",
    values: Sequence[str] = ("First_Innings_Score", "Second_Innings_Score"),
) -> DataFrame:
    """One row per side of a pairing, each with all of the pairing's values.

    Names are normalised after the split; ``"before_split"`` looks up the whole
    text of the pairing instead, which no single name can match.
    """
    if normalize_pairs not in ("after_split", "before_split"):
        raise ValueError(f"unknown normalize_pairs: {normalize_pairs}")
    if names is not None and normalize_pairs == "before_split":
        perf = normalize_names(perf, [team], names)
    halves = split_pair(perf, team)
    if names is not None and normalize_pairs == "after_split":
        halves = normalize_names(halves, ["team_A", "team_B"], names)
    sides = [
        F.struct(F.col(half).alias("Team"), *[F.col(v).alias(v) for v in values])
        for half in ("team_A", "team_B")
    ]
    return halves.select(F.inline(F.array(*sides)))


def team_score_averages(
    perf: DataFrame,
    names: Mapping[str, str] | DataFrame | None = None,
    normalize_pairs: str = "after_split",
    team: str = "Team",
    first: str = "First_Innings_Score",
    second: str = "Second_Innings_Score",
) -> DataFrame:
    """Mean of both innings scores over all contests of a team.

    Scores are summed per pairing text first, so splitting and normalising
    handle one row per distinct pairing.
    """
    totals = perf.groupBy(team).agg(
        F.sum(first).alias("first_sum"),
        F.count(first).alias("first_n"),
        F.sum(second).alias("second_sum"),
        F.count(second).alias("second_n"),
    )
    parts = ("first_sum", "first_n", "second_sum", "second_n")

    def mean(side: str) -> Column:
        return F.try_divide(F.sum(f"{side}_sum"), F.sum(f"{side}_n").cast("double"))

    return (
        score_rows(totals, names, normalize_pairs, team, parts)
        .groupBy("Team")
        .agg(
            mean("first").alias("avg_first_innings_score"),
            mean("second").alias("avg_second_innings_score"),
        )
    )
