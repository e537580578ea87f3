"""Outcome, phase and rate expressions; all are built-in columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contestlab.columns import CONTEST, ContestColumns
from contestlab.constants import MIDDLE_END, PHASES, POWERPLAY_END, RATE_DIGITS


def draw_flag(c: ContestColumns = CONTEST) -> Column:
    """The draw winner won the contest; NULL when there is no result."""
    return F.col(c.draw_winner) == F.col(c.winner)


def draw_flag_int(c: ContestColumns = CONTEST) -> Column:
    """The same flag as 0/1, where no result counts as 0."""
    return F.coalesce(draw_flag(c).cast("int"), F.lit(0))


def label_side_a(c: ContestColumns = CONTEST) -> Column:
    """1 when the first-named side won, else 0 (no result included)."""
    return F.coalesce((F.col(c.winner) == F.col(c.side_a)).cast("int"), F.lit(0))


def first_side(c: ContestColumns = CONTEST) -> Column:
    """The side batting first; any decision but "bat" sends the other side in."""
    drew, a, b = F.col(c.draw_winner), F.col(c.side_a), F.col(c.side_b)
    return F.when(F.col(c.decision) == "bat", drew).when(drew == a, b).otherwise(a)


def draw_winner_is_a(c: ContestColumns = CONTEST) -> Column:
    return F.coalesce((F.col(c.draw_winner) == F.col(c.side_a)).cast("int"), F.lit(0))


def is_wicket(flag: str = "is_wicket", kind: str = "dismissal_kind") -> Column:
    return (F.col(flag) == 1) & F.col(kind).isNotNull()


def over_number(ball: str = "ball_no") -> Column:
    return F.floor(F.col(ball)).cast("bigint")


def over_phase(
    over: str = "over", powerplay_end: int = POWERPLAY_END, middle_end: int = MIDDLE_END
) -> Column:
    """Phase of an over. A missing over falls into the last phase."""
    powerplay, middle, death = PHASES
    n = F.col(over)
    return F.when(n <= powerplay_end, powerplay).when(n <= middle_end, middle).otherwise(death)


def rate(part: Column, whole: Column, digits: int | None = RATE_DIGITS) -> Column:
    """part / whole, rounded; NULL (never an error) when whole is 0."""
    share = F.try_divide(part.cast("double"), whole.cast("double"))
    return share if digits is None else F.round(share, digits)
