"""DuckDB text of the fixture views (fixed values: the same formulas as
``dimforge.sources.fixtures``), prepended as CTEs to every oracle query."""

from __future__ import annotations

VIEW_SQL = {
    "player_seasons": """
SELECT c_name AS player_name, c_mktsegment AS college, n_name AS country,
       cast(170 + c_custkey % 50 AS varchar) AS height,
       CASE WHEN c_custkey % 7 = 0 THEN 'Undrafted' ELSE cast(1985 + c_custkey % 10 AS varchar) END AS draft_year,
       cast(year(o_orderdate) AS int) AS season,
       cast(year(o_orderdate) - 1975 + c_custkey % 10 AS int) AS age,
       cast(count(*) AS int) AS gp,
       cast(max(cast(floor(o_totalprice) AS bigint) % 40) AS double) AS pts,
       cast(max(o_orderkey % 15) AS double) AS reb,
       cast(min(o_orderkey % 12) AS double) AS ast
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY c_name, c_mktsegment, n_name, c_custkey, year(o_orderdate)""",
    "actor_films": """
SELECT concat('Actor ', cast(o_custkey % 1400 AS varchar)) AS actor,
       concat('a', cast(o_custkey AS varchar)) AS actor_id,
       concat('Film ', cast(o_orderkey AS varchar)) AS film,
       cast(year(o_orderdate) AS int) AS year,
       cast(floor(o_totalprice) AS int) AS votes,
       cast((o_orderkey * 7919) % 101 AS double) / 10 AS rating,
       concat('f', cast(o_orderkey AS varchar)) AS film_id
FROM orders""",
    "web_events": """
SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS user_id, ts AS event_time,
       CASE WHEN event_type = 'view' THEN '/' ELSE concat('/', event_type) END AS url,
       event_id % 25 AS device_id
FROM events""",
    "devices": """
SELECT cast(n_nationkey AS bigint) AS device_id, r_name AS browser_type
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "games": """
SELECT o_orderkey AS game_id, cast(o_orderdate AS date) AS game_date_est, cast(year(o_orderdate) AS int) AS season,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS home_team_wins,
       o_custkey % 30 AS home_team_id, (o_custkey + 7) % 30 AS visitor_team_id
FROM orders""",
    "game_details": """
SELECT l_orderkey AS game_id,
       CASE WHEN l_linenumber % 2 = 0 THEN o_custkey % 30 ELSE (o_custkey + 7) % 30 END AS team_id,
       cast(l_linenumber AS bigint) AS player_id,
       l_partkey, l_suppkey,
       l_returnflag AS start_position,
       CASE l_returnflag WHEN 'R' THEN 'DND - injury' WHEN 'A' THEN 'NWT - personal' ELSE NULL END AS comment,
       CASE WHEN l_linenumber = 7 THEN NULL
            WHEN l_linenumber = 6 THEN cast(cast(l_quantity AS int) AS varchar)
            ELSE concat(cast(cast(l_quantity AS int) AS varchar), ':', lpad(cast(l_partkey % 60 AS varchar), 2, '0')) END AS min,
       cast(l_quantity AS int) AS pts, cast(l_partkey % 12 AS int) AS reb, cast(l_suppkey % 9 AS int) AS ast
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "box_scores": """
SELECT *, cast(l_partkey % 15 AS int) AS fgm, cast(l_partkey % 15 + l_suppkey % 10 AS int) AS fga,
       cast(l_partkey % 6 AS int) AS fg3m, cast(l_partkey % 6 + 2 AS int) AS fg3a, cast(l_suppkey % 8 AS int) AS ftm,
       cast(l_suppkey % 8 + 1 AS int) AS fta, cast(l_partkey % 5 AS int) AS oreb, cast(l_suppkey % 7 AS int) AS dreb,
       cast(l_partkey % 4 AS int) AS stl, cast(l_suppkey % 3 AS int) AS blk, cast(l_partkey % 7 AS int) AS "to",
       cast(l_suppkey % 6 AS int) AS pf, cast(l_partkey % 41 - 20 AS int) AS plus_minus,
       concat('Player ', cast(player_id AS varchar)) AS player_name, concat('T', cast(team_id AS varchar)) AS team_abbreviation
FROM game_details""",
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` (which may start with its own ``WITH``-less CTE list
    after a comma) with the named fixture views."""
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]}\n)" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
