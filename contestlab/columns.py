"""Names of the contest columns; pass another instance for another schema."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ContestColumns:
    key: str = "match_id"
    side_a: str = "team1"
    side_b: str = "team2"
    draw_winner: str = "toss_winner"
    decision: str = "toss_decision"
    winner: str = "winner"
    season: str = "season"
    venue: str = "venue"
    city: str = "city"
    player: str = "player_of_match"

    @property
    def names(self) -> list[str]:
        """The columns that hold a participant's name."""
        return [self.side_a, self.side_b, self.draw_winner, self.winner]


CONTEST = ContestColumns()
