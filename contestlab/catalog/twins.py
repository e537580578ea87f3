"""Common table expressions shared by the SQL twins."""

from __future__ import annotations

from contestlab.catalog.fixtures import NAMES

_NAME_ROWS = ", ".join(f"('{old}', '{new}')" for old, new in NAMES.items())

# name -> (expressions it reads, text)
_CTES: dict[str, tuple[list[str], str]] = {
    "name_map": ([], f"SELECT * FROM (VALUES {_NAME_ROWS}) AS t(old_name, new_name)"),
    "contests": (
        [],
        """
        SELECT o.*, c.c_name, a.n_name AS team1, b.n_name AS team2
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation a ON a.n_nationkey = c.c_nationkey
        JOIN nation b ON b.n_nationkey = (c.c_nationkey + 1 + o.o_orderkey % 24) % 25""",
    ),
    "raw_matches": (
        ["contests"],
        """
        SELECT o_orderkey AS match_id,
               CAST(year(o_orderdate) AS VARCHAR) AS season,
               r_name AS city,
               'VENUE_' || CAST(o_custkey % 40 AS VARCHAR) AS venue,
               team1, team2,
               CASE WHEN o_custkey % 2 = 0 THEN team1 ELSE team2 END AS toss_winner,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'bat'
                    ELSE 'field' END AS toss_decision,
               CASE o_orderstatus WHEN 'F' THEN team1 WHEN 'O' THEN team2 END AS winner,
               c_name AS player_of_match
        FROM contests LEFT JOIN region ON r_regionkey = o_orderkey % 6""",
    ),
    "matches": (
        ["raw_matches", "name_map"],
        """
        SELECT m.match_id, m.season, m.city, m.venue,
               coalesce(a.new_name, m.team1) AS team1,
               coalesce(b.new_name, m.team2) AS team2,
               coalesce(t.new_name, m.toss_winner) AS toss_winner,
               m.toss_decision,
               coalesce(w.new_name, m.winner) AS winner,
               m.player_of_match
        FROM raw_matches m
        LEFT JOIN name_map a ON a.old_name = m.team1
        LEFT JOIN name_map b ON b.old_name = m.team2
        LEFT JOIN name_map t ON t.old_name = m.toss_winner
        LEFT JOIN name_map w ON w.old_name = m.winner""",
    ),
    "flagged": (
        ["matches"],
        """
        SELECT *, toss_winner = winner AS toss_match_win,
               CASE WHEN winner = team1 THEN 1 ELSE 0 END AS label,
               CASE WHEN toss_decision = 'bat' THEN toss_winner
                    WHEN toss_winner = team1 THEN team2
                    ELSE team1 END AS bat_first_team
        FROM matches""",
    ),
    "deliveries": (
        ["contests"],
        """
        SELECT l_orderkey AS match_id,
               CASE WHEN l_linenumber <= 4 THEN 1 ELSE 2 END AS inning,
               CASE WHEN l_linenumber <= 4 THEN team1 ELSE team2 END AS batting_team,
               CASE WHEN l_linenumber <= 4 THEN team2 ELSE team1 END AS bowling_team,
               s_name AS batter, p_brand AS bowler,
               CAST(l_quantity AS INTEGER) % 7 AS batsman_runs,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_wicket,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN p_type
                    END AS dismissal_kind
        FROM lineitem
        JOIN contests ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN part ON l_partkey = p_partkey""",
    ),
    "balls": (
        ["contests"],
        """
        SELECT CASE WHEN l_linenumber <= 4 THEN team1 ELSE team2 END AS batting_team,
               CASE WHEN l_linenumber <= 4 THEN team2 ELSE team1 END AS bowling_team,
               CAST(CAST(CAST(l_quantity AS INTEGER) % 20 AS VARCHAR) || '.'
                    || CAST(l_linenumber AS VARCHAR) AS DOUBLE) AS ball_no,
               CAST(l_quantity AS INTEGER) % 7 AS runs_scored
        FROM lineitem JOIN contests ON l_orderkey = o_orderkey""",
    ),
    "phased": (
        ["balls"],
        """
        SELECT *, CAST(floor(ball_no) AS BIGINT) AS over_no,
               CASE WHEN floor(ball_no) <= 6 THEN 'Powerplay'
                    WHEN floor(ball_no) <= 15 THEN 'Middle Overs'
                    ELSE 'Death Overs' END AS phase
        FROM balls""",
    ),
    "raw_perf": (
        ["contests"],
        """
        SELECT team1, team2,
               CAST(sum(CASE WHEN l_linenumber <= 4 THEN CAST(l_quantity AS INTEGER) % 7 END)
                    AS DOUBLE) AS first_score,
               CAST(sum(CASE WHEN l_linenumber > 4 THEN CAST(l_quantity AS INTEGER) % 7 END)
                    AS DOUBLE) AS second_score
        FROM lineitem JOIN contests ON l_orderkey = o_orderkey
        GROUP BY o_orderkey, team1, team2""",
    ),
    "perf": (
        ["raw_perf", "name_map"],
        """
        SELECT coalesce(a.new_name, team1) AS team_a, coalesce(b.new_name, team2) AS team_b,
               first_score, second_score
        FROM raw_perf
        LEFT JOIN name_map a ON a.old_name = team1
        LEFT JOIN name_map b ON b.old_name = team2""",
    ),
    "score_rows": (
        ["perf"],
        """
        SELECT team_a AS team, first_score, second_score FROM perf
        UNION ALL SELECT team_b, first_score, second_score FROM perf""",
    ),
    "averages": (
        ["score_rows"],
        """
        SELECT team, avg(first_score) AS avg_first, avg(second_score) AS avg_second
        FROM score_rows GROUP BY team""",
    ),
    "season_sides": (
        ["matches"],
        """
        SELECT season, team1 AS team FROM matches
        UNION ALL SELECT season, team2 FROM matches""",
    ),
    "season_won": (
        ["matches"],
        """
        SELECT season, winner AS team, count(*) AS season_wins
        FROM matches GROUP BY season, winner""",
    ),
    "season_played": (
        ["season_sides"],
        """
        SELECT season, team, count(*) AS season_matches
        FROM season_sides GROUP BY season, team""",
    ),
    "season_rate": (
        ["season_won", "season_played"],
        """
        SELECT p.season, p.team, p.season_matches,
               coalesce(w.season_wins, 0) AS season_wins,
               round(coalesce(w.season_wins, 0) / CAST(p.season_matches AS DOUBLE), 3)
                   AS season_win_rate
        FROM season_played p
        LEFT JOIN season_won w ON w.season = p.season AND w.team = p.team""",
    ),
    "venue_sides": (
        ["matches"],
        """
        SELECT venue, team1 AS team FROM matches
        UNION ALL SELECT venue, team2 FROM matches""",
    ),
    "venue_won": (
        ["matches"],
        """
        SELECT venue, winner AS team, count(*) AS venue_wins
        FROM matches GROUP BY venue, winner""",
    ),
    "venue_played": (
        ["venue_sides"],
        """
        SELECT venue, team, count(*) AS venue_matches
        FROM venue_sides GROUP BY venue, team""",
    ),
    "venue_rate": (
        ["venue_won", "venue_played"],
        """
        SELECT p.venue, p.team, p.venue_matches,
               coalesce(w.venue_wins, 0) AS venue_wins,
               round(coalesce(w.venue_wins, 0) / CAST(p.venue_matches AS DOUBLE), 3)
                   AS venue_win_rate
        FROM venue_played p
        LEFT JOIN venue_won w ON w.venue = p.venue AND w.team = p.team""",
    ),
    "pair_played": (
        ["matches"],
        """
        SELECT team1, team2, count(*) AS h2h_total_matches
        FROM matches GROUP BY team1, team2""",
    ),
    "pair_won": (
        ["matches"],
        """
        SELECT team1, team2, count(*) AS h2h_team1_wins
        FROM matches WHERE winner = team1 GROUP BY team1, team2""",
    ),
    "pair_rate": (
        ["pair_played", "pair_won"],
        """
        SELECT p.team1, p.team2, p.h2h_total_matches,
               coalesce(w.h2h_team1_wins, 0) AS h2h_team1_wins,
               round(coalesce(w.h2h_team1_wins, 0) / CAST(p.h2h_total_matches AS DOUBLE), 3)
                   AS h2h_win_rate
        FROM pair_played p
        LEFT JOIN pair_won w ON w.team1 = p.team1 AND w.team2 = p.team2""",
    ),
    "base": (
        ["flagged", "averages"],
        """
        SELECT f.*, a.avg_first AS team1_avg_runs, b.avg_second AS team2_avg_conceded
        FROM flagged f
        LEFT JOIN averages a ON a.team = f.team1
        LEFT JOIN averages b ON b.team = f.team2""",
    ),
    "smart": (
        ["base", "pair_rate", "season_rate", "venue_rate"],
        """
        SELECT m.*, p.h2h_win_rate,
               s1.season_win_rate AS team1_season_win_rate,
               s2.season_win_rate AS team2_season_win_rate,
               v.venue_win_rate AS team1_venue_win_rate
        FROM base m
        LEFT JOIN pair_rate p ON p.team1 = m.team1 AND p.team2 = m.team2
        LEFT JOIN season_rate s1 ON s1.season = m.season AND s1.team = m.team1
        LEFT JOIN season_rate s2 ON s2.season = m.season AND s2.team = m.team2
        LEFT JOIN venue_rate v ON v.venue = m.venue AND v.team = m.team1""",
    ),
    "requests": (
        ["contests", "name_map"],
        """
        SELECT request_id, city, venue,
               coalesce(a.new_name, team1) AS team1, coalesce(b.new_name, team2) AS team2,
               neutral, draw_winner_is_team1
        FROM (
            SELECT o_orderkey AS request_id, r_name AS city,
                   CASE WHEN o_orderkey % 53 = 0 THEN 'NEW_GROUND'
                        ELSE 'VENUE_' || CAST(o_custkey % 40 AS VARCHAR) END AS venue,
                   team1,
                   CASE WHEN o_orderkey % 101 = 0 THEN 'NEWCOMERS'
                        ELSE 'NATION_' || CAST((o_orderkey + o_custkey) % 25 AS VARCHAR)
                        END AS team2,
                   CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 0 END AS neutral,
                   CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS draw_winner_is_team1
            FROM contests LEFT JOIN region ON r_regionkey = o_orderkey % 6
        ) r
        LEFT JOIN name_map a ON a.old_name = r.team1
        LEFT JOIN name_map b ON b.old_name = r.team2""",
    ),
    "homes": (
        ["name_map"],
        """
        SELECT DISTINCT coalesce(new_name, n_name) AS team, r_name AS city
        FROM nation
        JOIN region ON r_regionkey = n_regionkey
        LEFT JOIN name_map ON old_name = n_name
        WHERE n_regionkey <> 4""",
    ),
}


def train_bucket(key: str, seed: int = 42) -> str:
    """SQL for the split number of a row, 0..99."""
    head = f"substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8)"
    return f"CAST('0x' || {head} AS BIGINT) % 100"


def trained_averages(percent: int = 80) -> dict[str, str]:
    """Expressions for ``averages`` of the scores of training contests only; they
    read ``contests`` and ``name_map``."""
    grouped = f"WHERE {train_bucket('o_orderkey')} < {percent} GROUP BY o_orderkey"
    own = {n: _CTES[n][1] for n in ("raw_perf", "perf", "score_rows", "averages")}
    return own | {"raw_perf": own["raw_perf"].replace("GROUP BY o_orderkey", grouped)}


def twin(select: str, *reads: str, **extra: str) -> str:
    """``select`` after the expressions it reads. ``extra`` are expressions of
    this twin alone, in the given order."""
    needed: list[str] = []

    def need(name: str) -> None:
        for other in _CTES[name][0]:
            need(other)
        if name not in needed:
            needed.append(name)

    for name in reads:
        need(name)
    parts = [f"{n} AS ({_CTES[n][1]})" for n in needed]
    parts += [f"{n} AS ({text})" for n, text in extra.items()]
    return f"WITH {', '.join(parts)} {select}" if parts else select
