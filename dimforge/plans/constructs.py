"""Queries exercising the single SQL constructs the modelling scripts use
(scan + filters, join shapes, window functions, sorts / limits, spines and
scalar function families), each over whole fixture tables.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from dimforge.functions.bits import bits_text, day_bit, popcount32
from dimforge.functions.scalars import day_of, exact_int
from dimforge.operators import facts as fa
from dimforge.operators import scd
from dimforge.operators.joins import full_outer
from dimforge.operators.windows import rank_within, running_total
from dimforge.plans import catalog as c
from dimforge.sources import fixtures as fx
from dimforge.sources import spine as sp
from dimforge.sources.tables import read_table


def q_scan_filter(spark, sf_dir):
    """Equality + conjunction filter on a scan (both pushed to Parquet)."""
    o = read_table(spark, sf_dir, "orders")
    return (o.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 100000))
             .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"))


def q_day_filter(spark, sf_dir):
    """Events of one day: ``to_date(ts) = d`` becomes a pushed timestamp range."""
    ev = fx.web_events(spark, sf_dir)
    return ev.where(day_of("event_time") == F.lit("2024-01-07").cast("date")) \
             .select("event_id", "user_id", "event_time", "url")


def q_comment_flags(spark, sf_dir):
    gd = fx.game_details(spark, sf_dir)
    return gd.select("game_id", "team_id", "player_id", "l_partkey", "l_suppkey",
                     F.col("comment").like("%DND%").alias("did_not_dress"),
                     F.col("comment").like("%NWT%").alias("not_with_team"))


def q_full_outer_one_key(spark, sf_dir):
    ps = fx.player_seasons(spark, sf_dir).select("player_name", "season", "pts")
    a = ps.where(F.col("season") == 2000)
    b = ps.where(F.col("season") == 2001)
    return full_outer(a, b, ["player_name"], lambda p, c: [
        F.coalesce(p("player_name"), c("player_name")).alias("player_name"),
        p("pts").alias("pts_2000"), c("pts").alias("pts_2001")], keys_not_null=True)


def q_full_outer_computed_key(spark, sf_dir):
    """Key + computed key: ``prev.end + 1 = cur.period`` (both equi-conditions)."""
    hist = c.players_activity(spark, sf_dir)
    prev = scd.scd2_backfill(hist, keys=["player_name"], state_cols=["is_active"], period="current_season",
                             as_of=2000).withColumn("_next", F.col("end_season") + 1)
    cur = hist.where(F.col("current_season") == 2001).select("player_name", "is_active", "current_season")
    p, q = prev.alias("p"), cur.alias("c")
    j = p.join(q, (F.col("p.player_name") == F.col("c.player_name"))
               & (F.col("p._next") == F.col("c.current_season")), "full_outer")
    return j.select(F.coalesce("p.player_name", "c.player_name").alias("player_name"),
                    F.col("p.start_season"), F.col("p.end_season"),
                    F.col("p.is_active").alias("was_active"), F.col("c.is_active").alias("is_active_now"))


def q_full_outer_two_keys(spark, sf_dir):
    d = c.daily(spark, sf_dir)
    a = d.where(F.col("date") == F.lit("2024-01-29").cast("date")).select("user_id", "metric_name", "metric_value")
    b = d.where(F.col("date") == F.lit("2024-01-30").cast("date")).select("user_id", "metric_name", "metric_value")
    return full_outer(a, b, ["user_id", "metric_name"], lambda p, c: [
        F.coalesce(p("user_id"), c("user_id")).alias("user_id"),
        F.coalesce(p("metric_name"), c("metric_name")).alias("metric_name"),
        p("metric_value").alias("value_d1"), c("metric_value").alias("value_d2")])


def q_inner_join(spark, sf_dir):
    g = fx.games(spark, sf_dir)
    gd = fx.game_details(spark, sf_dir)
    return g.join(gd, "game_id").select("game_id", "team_id", "player_id", "l_partkey", "l_suppkey",
                                        "season", "home_team_id")


def q_lag_prev(spark, sf_dir):
    ps = fx.player_seasons(spark, sf_dir)
    w = Window.partitionBy("player_name").orderBy("season")
    return ps.select("player_name", "season", "pts", F.lag("pts", 1).over(w).alias("pts_prev"))


def q_lead_next(spark, sf_dir):
    ps = fx.player_seasons(spark, sf_dir)
    w = Window.partitionBy("player_name").orderBy("season")
    return ps.select("player_name", "season", "pts", F.lead("pts", 1).over(w).alias("pts_next"))


def q_running_sum_range(spark, sf_dir):
    """Running SUM with the default frame (RANGE ... CURRENT ROW): films of
    the same year are peers and share the value.  Films per actor are
    unbounded, so a hot actor is split into range chunks."""
    af = fx.actor_films(spark, sf_dir).select("actor_id", "film_id", "year", "votes")
    return running_total(af, key="actor_id", order="year", value="votes", out="running_votes")


def q_rank_per_key(spark, sf_dir):
    af = fx.actor_films(spark, sf_dir).select("actor_id", "film_id", "votes")
    return rank_within(af, key="actor_id", order=[F.col("votes").desc()], out="votes_rank")


def q_collect_rows(spark, sf_dir):
    """ARRAY_AGG(ROW(...)) per actor-year, made deterministic by sorting."""
    af = fx.actor_films(spark, sf_dir)
    g = af.groupBy("actor_id", "year").agg(
        F.sort_array(F.collect_list(F.struct("film", "votes", "rating", "film_id")), asc=False).alias("films"))
    return g.select("actor_id", "year", F.size("films").alias("n_films"),
                    F.array_join(F.transform("films", lambda f: f["film"]), ",").alias("films_text"))


def q_sorted_limit(spark, sf_dir):
    """Top 100 duplicated keys (the limit is the report)."""
    counts = fa.duplicate_counts(fx.game_details(spark, sf_dir, grouped=True), c.DEDUPE_KEYS)
    return counts.orderBy(F.col("counts").desc(), *c.DEDUPE_KEYS).limit(100)


def q_spine_ints(spark, sf_dir):
    return sp.entity_spine(fx.player_seasons(spark, sf_dir), ["player_name"], "season")


def q_spine_dates(spark, sf_dir):
    ev = fx.web_events(spark, sf_dir).where(F.col("user_id").isNotNull()) \
           .select("user_id", day_of("event_time").alias("day"))
    return sp.entity_spine(ev, ["user_id"], "day")


def q_fn_dates(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "value")
    d = day_of("ts")
    return e.select("event_id", d.alias("event_date"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day_start"),
                    F.datediff(F.lit(c.DAY_HI).cast("date"), d).alias("days_before_end"),
                    exact_int("value").alias("value_int"), F.col("value").cast("bigint").alias("value_trunc"))


def q_fn_bits(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", "event_id", "ts")
    b = day_bit(day_of("ts"), F.lit(c.DAY_HI).cast("date"))
    return e.select("event_id", b.alias("day_bit"), bits_text(b).alias("day_bit_text"),
                    popcount32(b).alias("n_bits"))


def q_fn_split(spark, sf_dir):
    gd = fx.game_details(spark, sf_dir)
    parts = F.split("min", ":")
    return gd.select("game_id", "player_id", "l_partkey", "l_suppkey", "min",
                     # NULL stays NULL whatever the session's legacy size-of-NULL setting
                     F.when(F.col("min").isNotNull(), F.size(parts)).alias("n_parts"),
                     F.try_element_at(parts, F.lit(1)).alias("part_1"),
                     F.try_element_at(parts, F.lit(2)).alias("part_2"))


def q_fn_arrays(spark, sf_dir):
    """CARDINALITY, CONTAINS, subscripts, REDUCE, concatenation on the
    cumulated seasons array."""
    h = c.players_hist(spark, sf_dir, snapshots="last")
    s = F.col("seasons")
    return h.select(
        "player_name",
        F.size(s).alias("n_seasons"),
        F.array_contains(s["season"], 2000).alias("played_2000"),
        F.element_at(s, 1)["season"].alias("latest_season"),
        F.element_at(s, -1)["season"].alias("first_season"),
        F.aggregate(s, F.lit(0).cast("bigint"), lambda acc, x: acc + x["gp"]).alias("total_gp"),
        F.size(F.concat(F.array(F.element_at(s, 1)), s)).alias("n_after_prepend"),
    )


def q_fn_map(spark, sf_dir):
    """MAP built per user (url -> hits) and unnested back to key / value."""
    ev = fx.web_events(spark, sf_dir)
    per = ev.groupBy("user_id", "url").agg(F.count(F.lit(1)).alias("hits"))
    m = per.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("url", "hits"))).alias("hits_by_url"))
    return m.select("user_id", F.size("hits_by_url").alias("n_urls"), F.explode("hits_by_url").alias("url", "hits"))


CONSTRUCTS = {
    "scan_filter": q_scan_filter,
    "day_filter": q_day_filter,
    "comment_flags": q_comment_flags,
    "full_outer_one_key": q_full_outer_one_key,
    "full_outer_computed_key": q_full_outer_computed_key,
    "full_outer_two_keys": q_full_outer_two_keys,
    "inner_join": q_inner_join,
    "lag_prev": q_lag_prev,
    "lead_next": q_lead_next,
    "running_sum_range": q_running_sum_range,
    "rank_per_key": q_rank_per_key,
    "collect_rows": q_collect_rows,
    "sorted_limit": q_sorted_limit,
    "spine_ints": q_spine_ints,
    "spine_dates": q_spine_dates,
    "fn_dates": q_fn_dates,
    "fn_bits": q_fn_bits,
    "fn_split": q_fn_split,
    "fn_arrays": q_fn_arrays,
    "fn_map": q_fn_map,
}
