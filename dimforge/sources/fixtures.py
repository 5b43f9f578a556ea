"""Views of the driver's tables that stand in for the inputs the modelling
scripts expect (player seasons, actor films, web events, devices, games and
game details).  Column formulas are fixed values shared with the DuckDB twins
in ``dimforge.plans.views_sql``; both read whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.operators.joins import broadcast_if_small, dealt_join
from dimforge.sources.tables import read_table

# Dimension tables of bounded size (TPC-H nation / region: 25 and 5 rows).
SMALL_DIM_ROWS = 100_000


def player_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (player, season): orders of a customer in a year.

    Orders are reduced to one row per (customer, year) *before* the join
    (Spark does not push aggregates below joins), then the customer and
    nation attributes are joined (broadcast only below a proven row count;
    a sort-merge join on the customer key beyond it) and the groups re-merged.  The second
    aggregation runs on the join's hash partitioning (key c_custkey is part
    of the grouping), so it adds no exchange, and it keeps the result exact
    even if a customer key were duplicated.
    """
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")

    per_year = (orders
                .groupBy(F.col("o_custkey"), F.year("o_orderdate").alias("yr"))
                .agg(F.count(F.lit(1)).alias("n"),
                     F.max(F.floor("o_totalprice").cast("bigint") % 40).alias("pts_max"),
                     F.max(F.col("o_orderkey") % 15).alias("reb_max"),
                     F.min(F.col("o_orderkey") % 12).alias("ast_min")))
    joined = (per_year
              .join(broadcast_if_small(customer, SMALL_DIM_ROWS), per_year.o_custkey == customer.c_custkey)
              .join(broadcast_if_small(nation, SMALL_DIM_ROWS), F.col("c_nationkey") == F.col("n_nationkey")))
    merged = (joined.groupBy("c_name", "c_mktsegment", "n_name", "c_custkey", "yr")
              .agg(F.sum("n").alias("n"), F.max("pts_max").alias("pts_max"),
                   F.max("reb_max").alias("reb_max"), F.min("ast_min").alias("ast_min")))
    k = F.col("c_custkey")
    return merged.select(
        F.col("c_name").alias("player_name"),
        F.col("c_mktsegment").alias("college"),
        F.col("n_name").alias("country"),
        (F.lit(170) + k % 50).cast("string").alias("height"),
        F.when(k % 7 == 0, F.lit("Undrafted")).otherwise((F.lit(1985) + k % 10).cast("string")).alias("draft_year"),
        F.col("yr").cast("int").alias("season"),
        (F.col("yr") - 1975 + k % 10).cast("int").alias("age"),
        F.col("n").cast("int").alias("gp"),
        F.col("pts_max").cast("double").alias("pts"),
        F.col("reb_max").cast("double").alias("reb"),
        F.col("ast_min").cast("double").alias("ast"),
    )


def actor_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (actor_id, film); 1,400 names over 1,500 ids (namesakes)."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return o.select(
        F.concat(F.lit("Actor "), (F.col("o_custkey") % 1400).cast("string")).alias("actor"),
        F.concat(F.lit("a"), F.col("o_custkey").cast("string")).alias("actor_id"),
        F.concat(F.lit("Film "), F.col("o_orderkey").cast("string")).alias("film"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.floor("o_totalprice").cast("int").alias("votes"),
        (((F.col("o_orderkey") * 7919) % 101).cast("double") / 10).alias("rating"),
        F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("film_id"),
    )


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with some NULL users (every 97th event)."""
    e = read_table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type")
    return e.select(
        "event_id",
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"),
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "view", F.lit("/")).otherwise(F.concat(F.lit("/"), F.col("event_type"))).alias("url"),
        (F.col("event_id") % 25).alias("device_id"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return (nation.join(broadcast_if_small(region, SMALL_DIM_ROWS), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_nationkey").cast("bigint").alias("device_id"), F.col("r_name").alias("browser_type")))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").cast("int").alias("season"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(0)).alias("home_team_wins"),
        (F.col("o_custkey") % 30).alias("home_team_id"),
        ((F.col("o_custkey") + 7) % 30).alias("visitor_team_id"),
    )


def game_details(spark: SparkSession, sf_dir: str, grouped: bool = False) -> DataFrame:
    """Line items as player box scores; duplicates on (game, team, player).
    ``grouped``: the rows are grouped by game next (``dealt_join``)."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    "l_returnflag", "l_quantity")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    j = dealt_join(li, o, "l_orderkey", "o_orderkey") if grouped else li.join(o, li.l_orderkey == o.o_orderkey)
    qty = F.col("l_quantity").cast("int").cast("string")
    return j.select(
        F.col("l_orderkey").alias("game_id"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("o_custkey") % 30)
         .otherwise((F.col("o_custkey") + 7) % 30).alias("team_id"),
        F.col("l_linenumber").cast("bigint").alias("player_id"),
        "l_partkey", "l_suppkey",
        F.col("l_returnflag").alias("start_position"),
        F.when(F.col("l_returnflag") == "R", F.lit("DND - injury"))
         .when(F.col("l_returnflag") == "A", F.lit("NWT - personal")).alias("comment"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
         .when(F.col("l_linenumber") == 6, qty)
         .otherwise(F.concat(qty, F.lit(":"), F.lpad((F.col("l_partkey") % 60).cast("string"), 2, "0"))).alias("min"),
        F.col("l_quantity").cast("int").alias("pts"),
        (F.col("l_partkey") % 12).cast("int").alias("reb"),
        (F.col("l_suppkey") % 9).cast("int").alias("ast"),
    )


def box_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box scores with every measure and dimension of the fact table."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    extra = {"fgm": part % 15, "fga": part % 15 + supp % 10, "fg3m": part % 6, "fg3a": part % 6 + 2, "ftm": supp % 8,
             "fta": supp % 8 + 1, "oreb": part % 5, "dreb": supp % 7, "stl": part % 4, "blk": supp % 3, "to": part % 7,
             "pf": supp % 6, "plus_minus": part % 41 - 20}
    return game_details(spark, sf_dir).select(
        "*", *[e.cast("int").alias(n) for n, e in extra.items()],
        F.concat(F.lit("Player "), F.col("player_id").cast("string")).alias("player_name"),
        F.concat(F.lit("T"), F.col("team_id").cast("string")).alias("team_abbreviation"))


VIEWS = {
    "player_seasons": player_seasons,
    "actor_films": actor_films,
    "web_events": web_events,
    "devices": devices,
    "games": games,
    "game_details": game_details,
    "box_scores": box_scores,
}


def register_views(spark: SparkSession, sf_dir: str, names=None) -> list[str]:
    """Register the input views as session temp views, so SQL written for
    these tables runs through ``spark.sql`` (planned by Catalyst like the
    DataFrame form).  Returns the registered names."""
    names = list(names or VIEWS)
    for n in names:
        VIEWS[n](spark, sf_dir).createOrReplaceTempView(n)
    return names
