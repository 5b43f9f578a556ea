"""Queries and DuckDB twins of the operators that keep a table up to date:
runs from gaps, streak states, upserts, partition statistics, checked casts,
joins on frequent keys, loads de-duplicated against what is stored.

Ranges of periods are taken from the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.functions.scalars import to_type
from dimforge.operators import scd
from dimforge.operators.joins import split_join
from dimforge.operators.streaks import STATE, merge_streaks, streak_states, streak_step
from dimforge.plans.catalog import DEDUPE_KEYS, dedupe_order
from dimforge.plans.oracle import ORACLE as _SQL
from dimforge.plans.views_sql import with_views
from dimforge.session import shared_dir
from dimforge.sinks import publish as pb
from dimforge.sinks.append import append_new
from dimforge.sinks.statistics import merged_statistics, partition_statistics
from dimforge.sinks.upsert import apply_changes
from dimforge.sources import fixtures as fx
from dimforge.sources.tables import read_table


def _stored(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint()


def _bounds(df: DataFrame, period: str) -> tuple[int, int] | None:
    """First and last period of a table (None: it is empty)."""
    lo, hi = df.agg(F.min(period), F.max(period)).first()
    return None if lo is None else (lo, hi)


def _path(spark, sf_dir: str, name: str) -> str:
    """A new table folder of this run."""
    return f"{pb.table_location(spark, sf_dir.rstrip('/').rsplit('/', 1)[-1], name)}-{uuid.uuid4().hex[:12]}"


# --- C6, C8: runs from gaps -------------------------------------------------------

def q_scd2_gaps(spark, sf_dir):
    seasons = _stored(fx.player_seasons(spark, sf_dir).select("player_name", "season"))
    lo, hi = _bounds(seasons, "season") or (0, 0)
    return scd.scd2_from_gaps(seasons, keys=["player_name"], period="season", lo=lo, hi=hi)


SCD2_GAPS = with_views("""
WITH b AS (SELECT min(season) AS lo, max(season) AS hi FROM player_seasons),
grid AS (
  SELECT n.player_name, y.yr, EXISTS (SELECT 1 FROM player_seasons p WHERE p.player_name = n.player_name AND p.season = y.yr) AS st
  FROM (SELECT DISTINCT player_name FROM player_seasons) n, (SELECT unnest(generate_series(lo, hi)) AS yr FROM b) y),
edge AS (
  SELECT g.*, h.st IS DISTINCT FROM g.st AS opens FROM grid g LEFT JOIN grid h ON h.player_name = g.player_name AND h.yr = g.yr - 1),
num AS (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY player_name ORDER BY yr) AS run FROM edge)
SELECT player_name, st AS is_active, cast(min(yr) AS int) AS start_season, cast(max(yr) AS int) AS end_season,
       max(yr) = (SELECT hi FROM b) AS is_current
FROM num GROUP BY player_name, st, run""", "player_seasons")


# --- C25: streaks season by season --------------------------------------------------

def q_streak_steps(spark, sf_dir):
    """Streaks of seasons at 20 points or more after every season, each from
    the states of the season before and the new season's rows."""
    seasons = _stored(fx.player_seasons(spark, sf_dir).select("player_name", "season", "pts"))
    path = _path(spark, sf_dir, "streak_states")
    lo, hi = _bounds(seasons, "season") or (0, 0)
    hits = seasons.where("pts >= 20")

    def step(prev, t):
        now = hits.where(F.col("season") == t)
        return streak_step(prev, now, keys=["player_name"], period="season").withColumn("as_of", F.lit(t))

    pb.load_periods(spark, path, "as_of", list(range(lo, hi + 1)), step)
    spec = "player_name string, " + ", ".join(f"{c} int" for c in STATE) + ", as_of int"
    return spark.read.schema(spec).parquet(path).select(
        "as_of", "player_name", F.col("longest").alias("longest_streak"), F.col("longest_start").alias("streak_start"),
        (F.col("longest_start") + F.col("longest") - 1).alias("streak_end"),
        F.when(F.col("last") == F.col("as_of"), F.col("tail")).otherwise(0).alias("running_streak"))


def q_streak_chunks(spark, sf_dir):
    """Streaks of days with an event per user (the NULL user too), from states
    of weeks that were made apart."""
    days = fx.web_events(spark, sf_dir).select("user_id", F.unix_date(F.to_date("event_time")).alias("day"))
    one = merge_streaks(streak_states(days, keys=["user_id"], period="day", chunk=7), keys=["user_id"])
    return one.select("user_id", F.date_from_unix_date("first").alias("first_day"), F.date_from_unix_date("last").alias("last_day"),
                      "head", "tail", F.col("longest").alias("longest_streak"),
                      F.date_from_unix_date("longest_start").alias("streak_start"))


STREAK_STEPS = with_views("""
WITH hits AS (SELECT DISTINCT player_name, season FROM player_seasons WHERE pts >= 20),
s AS (SELECT a.* FROM hits a ANTI JOIN hits b ON a.player_name = b.player_name AND b.season = a.season - 1),
e AS (SELECT a.* FROM hits a ANTI JOIN hits b ON a.player_name = b.player_name AND b.season = a.season + 1),
runs AS (SELECT s.player_name, s.season AS s, min(e.season) AS e
         FROM s JOIN e ON s.player_name = e.player_name AND e.season >= s.season GROUP BY 1, 2),
t AS (SELECT cast(unnest(generate_series(min(season), max(season))) AS int) AS as_of FROM player_seasons),
c AS (SELECT as_of, player_name, s, least(e, as_of) AS e FROM runs JOIN t ON as_of >= s),
r AS (SELECT *, row_number() OVER (PARTITION BY as_of, player_name ORDER BY e - s DESC, s) AS rk,
             max(CASE WHEN e = as_of THEN e - s + 1 ELSE 0 END) OVER (PARTITION BY as_of, player_name) AS running FROM c)
SELECT as_of, player_name, cast(e - s + 1 AS int) AS longest_streak, cast(s AS int) AS streak_start,
       cast(e AS int) AS streak_end, cast(running AS int) AS running_streak
FROM r WHERE rk = 1""", "player_seasons")

STREAK_CHUNKS = with_views("""
WITH d AS (SELECT DISTINCT coalesce(user_id, -1) AS u, cast(event_time AS date) AS day FROM web_events),
runs AS (SELECT u, min(day) AS s, max(day) AS e, count(*) AS n
         FROM (SELECT *, day - cast(row_number() OVER (PARTITION BY u ORDER BY day) AS int) AS isl FROM d) GROUP BY u, isl),
r AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY n DESC, s) AS rk, first_value(n) OVER (PARTITION BY u ORDER BY s) AS head,
             first_value(n) OVER (PARTITION BY u ORDER BY s DESC) AS tail, min(s) OVER (PARTITION BY u) AS first_day,
             max(e) OVER (PARTITION BY u) AS last_day FROM runs)
SELECT nullif(u, -1) AS user_id, first_day, last_day, cast(head AS int) AS head, cast(tail AS int) AS tail,
       cast(n AS int) AS longest_streak, s AS streak_start
FROM r WHERE rk = 1""", "web_events")


# --- C29, S8: change sets -----------------------------------------------------------

def q_upsert_changes(spark, sf_dir):
    """Games by season under a change set, applied twice: the first season
    goes; in even seasons some games are deleted, corrected, moved two seasons
    on or added; some are told about twice, of which the later word counts."""
    games, path = fx.games(spark, sf_dir), _path(spark, sf_dir, "games_upsert")
    stored = _stored(games)
    lo, hi = _bounds(stored, "season") or (0, 0)
    pb.publish(stored, path, ["season"])
    kind, even = F.col("game_id") % 7, F.col("season") % 2 == 0
    gone = (F.col("season") == lo) | (even & (kind == 1))
    told = stored.where(gone | (even & kind.isin(2, 3, 4))).withColumn("deleted", gone).withColumn("said", F.lit(2))
    told = told.select(
        F.when(gone | (kind != 4), F.col("game_id")).otherwise(-F.col("game_id")).alias("game_id"), "game_date_est",
        F.when(~gone & (kind == 3), F.col("season") + 2).otherwise(F.col("season")).alias("season"),
        F.when(~gone & (kind == 2), 1 - F.col("home_team_wins")).otherwise(F.col("home_team_wins")).alias("home_team_wins"),
        "home_team_id", "visitor_team_id", "deleted", "said")
    earlier = told.withColumns({"home_team_wins": F.lit(9), "deleted": ~F.col("deleted"), "said": F.lit(1)})
    changes = told.unionByName(earlier)
    for _ in range(2):
        apply_changes(changes, path, keys=["game_id"], partition="season", order=["said"])
    return spark.read.schema(games.schema).parquet(path)


UPSERT_CHANGES = with_views("""
WITH lo AS (SELECT min(season) AS s FROM games),
keep AS (SELECT *, season % 2 = 0 AS even, game_id % 7 AS kind FROM games WHERE season > (SELECT s FROM lo))
SELECT game_id, game_date_est, cast(season + CASE WHEN even AND kind = 3 THEN 2 ELSE 0 END AS int) AS season,
       cast(CASE WHEN even AND kind = 2 THEN 1 - home_team_wins ELSE home_team_wins END AS int) AS home_team_wins,
       home_team_id, visitor_team_id
FROM keep WHERE NOT (even AND kind = 1)
UNION ALL
SELECT -game_id, game_date_est, season, home_team_wins, home_team_id, visitor_team_id FROM keep WHERE even AND kind = 4""", "games")


# --- C28: statistics per partition -----------------------------------------------------

STAT_COLUMNS = ("film_id", "actor", "votes", "rating")


def q_partition_statistics(spark, sf_dir):
    """Column statistics of all film years but the first and the last, from
    the stored statistics of each year.  Distinct counts and medians are
    sketched: the exact ones, read from the table, tell whether they are inside
    the stated bounds (three standard errors; a rank within 2 %)."""
    films = _stored(fx.actor_films(spark, sf_dir).select("year", *STAT_COLUMNS))
    path = _path(spark, sf_dir, "film_statistics")
    pb.publish(partition_statistics(films, ["year"], STAT_COLUMNS), path, ["year"])
    lo, hi = _bounds(films, "year") or (0, 0)
    inside = (F.col("year") > lo) & (F.col("year") < hi)
    merged = _stored(merged_statistics(spark.read.parquet(path).where(inside), STAT_COLUMNS))
    medians = {r["column_name"]: r["quantiles"][0] for r in merged.where("quantiles IS NOT NULL").collect()}     # one per column
    exact = films.where(inside).agg(
        *[F.countDistinct(c).alias(f"{c}_d") for c in STAT_COLUMNS],
        *[x for c, m in medians.items() for x in (F.avg((F.col(c) < m).cast("int")).alias(f"{c}_lt"), F.avg((F.col(c) <= m).cast("int")).alias(f"{c}_le"))])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_d").alias("exact"),
                              ((F.col(f"{c}_lt") <= 0.52) & (F.col(f"{c}_le") >= 0.48) if c in medians else F.lit(None).cast("boolean")).alias("median_ok"))
                     for c in STAT_COLUMNS])
    exact = exact.select(F.inline(rows))
    close = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.05 * F.col("exact"))
    return merged.join(F.broadcast(exact), "column_name").select("column_name", "n_rows", "n_nulls", "min_value", "max_value",
                                                                 close.alias("distinct_ok"), "median_ok")


PARTITION_STATISTICS = with_views("""
WITH f AS (SELECT * FROM actor_films WHERE year > (SELECT min(year) FROM actor_films) AND year < (SELECT max(year) FROM actor_films))
""" + "\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, cast(min({c}) AS varchar) AS min_value,
       cast(max({c}) AS varchar) AS max_value, true AS distinct_ok, {'true' if c in ('votes', 'rating') else 'cast(NULL AS boolean)'} AS median_ok
FROM f""" for c in STAT_COLUMNS), "actor_films")


# --- F2: checked casts ---------------------------------------------------------------

def q_fn_try_cast(spark, sf_dir):
    return fx.game_details(spark, sf_dir).select(
        "game_id", "player_id", "l_partkey", "l_suppkey", "min", to_type("min", "int").alias("min_int"),
        to_type(F.col("l_partkey") * 100, "smallint").alias("small_part"), to_type("comment", "date").alias("comment_date"),
        to_type(F.col("pts").cast("string"), "double", strict=True).alias("pts_double"))


FN_TRY_CAST = with_views("""
SELECT game_id, player_id, l_partkey, l_suppkey, min, TRY_CAST(min AS int) AS min_int,
       CASE WHEN l_partkey * 100 BETWEEN -32768 AND 32767 THEN cast(l_partkey * 100 AS smallint) END AS small_part,
       TRY_CAST(comment AS date) AS comment_date, cast(pts AS double) AS pts_double
FROM game_details""", "game_details")


# --- J7, C14: frequent keys -------------------------------------------------------------

def q_events_split_join(spark, sf_dir):
    """Events with the profile of their user; users with more than a 32nd of the
    events and events without a user are not shuffled."""
    events = _stored(fx.web_events(spark, sf_dir).select("event_id", "user_id", "url"))
    profiles = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment").withColumnRenamed("c_custkey", "user_id")
    return split_join(events, profiles, ["user_id"], parts=32)


EVENTS_SPLIT_JOIN = with_views("""
SELECT e.event_id, e.user_id, e.url, c.c_name, c.c_mktsegment FROM web_events e LEFT JOIN customer c ON c.c_custkey = e.user_id""",
                               "web_events")


# --- C18, C19: facts that arrive in loads ---------------------------------------------------

def q_dedupe_loads(spark, sf_dir):
    """Box scores in four loads by part number, which the order of a
    de-duplication starts with, each run twice: what one de-duplication of all
    rows keeps."""
    season = fx.games(spark, sf_dir).select("game_id", "season")
    rows = _stored(fx.game_details(spark, sf_dir).join(season, "game_id"))
    path = _path(spark, sf_dir, "game_details_loads")
    lo, hi = _bounds(rows, "l_partkey") or (0, 0)
    step = (hi - lo) // 4 + 1
    for i in range(4):
        load = rows.where(F.col("l_partkey").between(lo + i * step, lo + (i + 1) * step - 1))
        for _ in range(2):
            append_new(load, path, keys=DEDUPE_KEYS, partition="season", order=dedupe_order())
    return spark.read.schema(rows.schema).parquet(path).drop("season")


QUERIES = {
    "events_split_join": q_events_split_join,
    "dedupe_loads": q_dedupe_loads,
    "scd2_gaps": q_scd2_gaps,
    "streak_steps": q_streak_steps,
    "streak_chunks": q_streak_chunks,
    "upsert_changes": q_upsert_changes,
    "partition_statistics": q_partition_statistics,
    "fn_try_cast": q_fn_try_cast,
}

ORACLE = {
    "events_split_join": EVENTS_SPLIT_JOIN,
    "dedupe_loads": _SQL["dedupe_first"],
    "scd2_gaps": SCD2_GAPS,
    "streak_steps": STREAK_STEPS,
    "streak_chunks": STREAK_CHUNKS,
    "upsert_changes": UPSERT_CHANGES,
    "partition_statistics": PARTITION_STATISTICS,
    "fn_try_cast": FN_TRY_CAST,
}
