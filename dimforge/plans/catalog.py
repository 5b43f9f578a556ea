"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through the fixture views) in full.
Arrays are flattened to text / scalar columns at the very end so the result
can be compared value by value with the DuckDB twin in
``dimforge.plans.oracle``; the operators themselves return the nested
tables.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.functions.scalars import clock_to_seconds
from dimforge.operators import analysis as an
from dimforge.operators import cumulate as cu
from dimforge.operators import datelist as dl
from dimforge.operators import facts as fa
from dimforge.operators import scd
from dimforge.operators.joins import broadcast_if_small
from dimforge.operators.segments import fold_segments, segments
from dimforge.operators.windows import rank_within, running_total, running_total_of_ties
from dimforge.session import shared_dir
from dimforge.sinks import ledger as lg
from dimforge.sinks import publish as pb
from dimforge.sources import fixtures as fx
from dimforge.sources import spine as sp

# The period ranges of the fixture data.
SEASON_LO, SEASON_HI = 1995, 2001          # player seasons / film years
DAY_LO, DAY_HI = "2024-01-01", "2024-01-31"  # web events (one month, fits a 31-bit history)


def _s(col) -> Column:
    return col.cast("string")


def seasons_text(col: str = "seasons") -> Column:
    return F.array_join(F.transform(col, lambda s: F.concat_ws(
        ":", _s(s["season"]), _s(s["age"]), _s(s["gp"]), _s(s["pts"].cast("int")),
        _s(s["reb"].cast("int")), _s(s["ast"].cast("int")))), ",")


def _players_flat(df: DataFrame) -> DataFrame:
    return df.select("player_name", *cu.PLAYER_ATTRS, F.size("seasons").alias("n_seasons"),
                     seasons_text().alias("seasons_text"), "is_active", "years_since_last_active",
                     "current_season")


def players_hist(spark: SparkSession, sf_dir: str, hi: int = SEASON_HI, snapshots: str = "all") -> DataFrame:
    return cu.players_cumulated(fx.player_seasons(spark, sf_dir), SEASON_LO, hi, snapshots=snapshots)


# --- cumulative dimension -------------------------------------------------

def q_cumulate_dim_backfill(spark, sf_dir):
    return _players_flat(players_hist(spark, sf_dir))


def _stored(df: DataFrame) -> DataFrame:
    """A snapshot as a step finds it: written once, then only read."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def q_cumulate_dim_step(spark, sf_dir):
    t = SEASON_HI
    ps = fx.player_seasons(spark, sf_dir)
    prev = _stored(cu.players_cumulated(ps, SEASON_LO, t - 1, snapshots="last"))
    cur = cu.period_items(ps.where(F.col("season") == t), keys=["player_name"], period="season",
                          item_cols=cu.SEASON_FIELDS, history_col="seasons", attrs=cu.PLAYER_ATTRS,
                          unique_per_period=True)
    step = cu.cumulate_step(prev, cur, keys=["player_name"], period="season", history_col="seasons",
                            snapshot_col="current_season", attrs=cu.PLAYER_ATTRS,
                            since_col="years_since_last_active", keys_not_null=True)
    return _players_flat(step)


# --- SCD2 -----------------------------------------------------------------

def players_activity(spark, sf_dir, hi: int = SEASON_HI):
    return cu.players_activity(fx.player_seasons(spark, sf_dir), SEASON_LO, hi)


def q_scd2_backfill(spark, sf_dir):
    return scd.scd2_backfill(players_activity(spark, sf_dir), keys=["player_name"], state_cols=["is_active"],
                             period="current_season", as_of=SEASON_HI)


def _players_increment(spark, sf_dir, open_end="period", compat=False):
    """Snapshot t-1 is stored; period t is the last snapshot of the activity."""
    hist = _stored(players_activity(spark, sf_dir))
    kw = dict(keys=["player_name"], state_cols=["is_active"], period="current_season", open_end=open_end)
    prev = _stored(scd.scd2_backfill(hist, as_of=SEASON_HI - 1, **kw))
    return scd.scd2_increment(prev, hist, t=SEASON_HI, compat=compat, keys_not_null=True, **kw)


def q_scd2_increment(spark, sf_dir):
    return _players_increment(spark, sf_dir)


def q_scd2_increment_compat(spark, sf_dir):
    """The script's three-valued change test (equal here: no NULL state)."""
    return _players_increment(spark, sf_dir, compat=True)


def q_scd2_increment_null_ends(spark, sf_dir):
    """Open runs stored with a NULL end."""
    return _players_increment(spark, sf_dir, open_end="null")


def q_scd2_late_periods(spark, sf_dir):
    """Seasons arrive out of order — odd ones, then even ones with every state
    wrong — and the even ones are corrected afterwards: the full load."""
    hist = _stored(players_activity(spark, sf_dir))
    kw = dict(keys=["player_name"], state_cols=["is_active"], period="current_season")
    odd, even = hist.where("current_season % 2 <> 0"), hist.where("current_season % 2 = 0")
    table = None
    for arrival in (odd, even.withColumn("is_active", ~F.col("is_active")), even):
        table = _stored(scd.scd2_splice(table, arrival, **kw))
    return table.withColumn("current_season", F.lit(SEASON_HI).cast("int"))


def q_scd2_spine(spark, sf_dir):
    return scd.scd2_from_spine(fx.player_seasons(spark, sf_dir), keys=["player_name"], period="season",
                               lo=SEASON_LO, hi=SEASON_HI)


# --- actors: multi-row periods, two-attribute SCD2 ------------------------------

def _actors_flat(df: DataFrame) -> DataFrame:
    return df.select("actor_id", "actor", F.size("films").alias("n_films"),
                     F.array_join(F.transform("films", lambda f: f["film_id"]), ",").alias("films_text"),
                     "quality_class", "is_active", "current_year")


def actors_hist(spark, sf_dir, mode="replace"):
    return cu.actors_cumulated(fx.actor_films(spark, sf_dir), SEASON_LO, SEASON_HI, mode=mode)


def q_cumulate_actors_accumulate(spark, sf_dir):
    return _actors_flat(actors_hist(spark, sf_dir, "accumulate"))


def q_cumulate_actors_replace(spark, sf_dir):
    return _actors_flat(actors_hist(spark, sf_dir, "replace"))


def q_quality_class(spark, sf_dir):
    return cu.actor_period_state(fx.actor_films(spark, sf_dir)).select("actor_id", "year", "n_films", "quality_class")


def _actors_step(spark, sf_dir, mode):
    """One year on top of the stored snapshot of the year before."""
    films = fx.actor_films(spark, sf_dir)
    prev = _stored(cu.actors_cumulated(films, SEASON_LO, SEASON_HI - 1, mode=mode, snapshots="last"))
    cur = cu.actor_period_rows(films.where(F.col("year") == SEASON_HI))
    kw = {"latest": ["quality_class"]} if mode == "replace" else {"current": {"quality_class": "bad"}}
    return _actors_flat(cu.cumulate_step(prev, cur, keys=["actor_id"], period="year", history_col="films",
                                         snapshot_col="current_year", attrs=["actor"], mode=mode,
                                         keys_not_null=True, **kw))


def q_cumulate_actors_accumulate_step(spark, sf_dir):
    return _actors_step(spark, sf_dir, "accumulate")


def q_cumulate_actors_replace_step(spark, sf_dir):
    return _actors_step(spark, sf_dir, "replace")


ACTOR_SCD = dict(period="current_year", start_col="start_date", end_col="end_date", snapshot_col="current_year")


def actors_state(spark, sf_dir):
    return cu.actors_state(fx.actor_films(spark, sf_dir), SEASON_LO, SEASON_HI)


def q_scd2_actors_backfill(spark, sf_dir):
    return scd.scd2_backfill(actors_state(spark, sf_dir), keys=["actor_id"], carry=["actor"],
                             state_cols=["quality_class", "is_active"], as_of=SEASON_HI, **ACTOR_SCD)


def q_scd2_actors_backfill_compat(spark, sf_dir):
    return scd.scd2_backfill_as_written(actors_state(spark, sf_dir), lag_key="actor_id", sum_key="actor",
                                        group_extra=["quality_class"], state="is_active", as_of=SEASON_HI,
                                        out_key="actor", **ACTOR_SCD)


def _actors_increment(spark, sf_dir, **how):
    hist = _stored(actors_state(spark, sf_dir))
    kw = dict(keys=["actor_id"], **ACTOR_SCD)
    prev = _stored(scd.scd2_backfill(hist, carry=["actor"], state_cols=["quality_class", "is_active"],
                                     as_of=SEASON_HI - 1, **kw))
    return scd.scd2_increment(prev, hist, t=SEASON_HI, keys_not_null=True, **kw, **how)


def q_scd2_actors_increment(spark, sf_dir):
    return _actors_increment(spark, sf_dir, carried=["actor"], state_cols=["quality_class", "is_active"])


def q_scd2_actors_increment_compat(spark, sf_dir):
    """The script's rule: only the activity decides, the class is carried."""
    return _actors_increment(spark, sf_dir, carried=["actor", "quality_class"], state_cols=["is_active"], compat=True)


# --- datelists and bit history ------------------------------------------------

def _dates_text(col: str = "dates_active") -> Column:
    return F.array_join(F.transform(col, lambda d: F.coalesce(F.date_format(d, "yyyy-MM-dd"), F.lit("-"))), ",")


def _datelist_flat(df: DataFrame, keys=("user_id",)) -> DataFrame:
    return df.select(*keys, F.size("dates_active").alias("n_slots"),
                     F.size(F.filter("dates_active", lambda d: d.isNotNull())).alias("n_active"),
                     _dates_text().alias("dates_text"), "curr_date")


def q_datelist_backfill(spark, sf_dir):
    d = dl.datelist_backfill(fx.web_events(spark, sf_dir), keys=["user_id"], ts_col="event_time",
                             lo=DAY_LO, hi=DAY_HI, snapshots="all")
    return _datelist_flat(d)


def q_datelist_compact(spark, sf_dir):
    """Datelist holding only the active days, newest first (no NULL slots)."""
    d = dl.datelist_backfill(fx.web_events(spark, sf_dir), keys=["user_id"], ts_col="event_time",
                             lo=DAY_LO, hi=DAY_HI, pad_nulls=False)
    return _datelist_flat(d)


STEP_DAY, STEP_PREV = "2024-01-30", "2024-01-29"


def q_datelist_step(spark, sf_dir):
    ev = fx.web_events(spark, sf_dir)
    prev = _stored(dl.datelist_backfill(ev, keys=["user_id"], ts_col="event_time", lo=DAY_LO, hi=STEP_PREV))
    return _datelist_flat(dl.datelist_step(prev, ev, keys=["user_id"], ts_col="event_time", day=STEP_DAY))


def q_datelist_bits(spark, sf_dir):
    d = dl.datelist_backfill(fx.web_events(spark, sf_dir), keys=["user_id"], ts_col="event_time",
                             lo=DAY_LO, hi=DAY_HI)
    return dl.datelist_bits(d, lo=DAY_LO, hi=DAY_HI)


def q_bits_direct(spark, sf_dir):
    return dl.bits_direct(fx.web_events(spark, sf_dir), ts_col="event_time", lo=DAY_LO, hi=DAY_HI)


def events_with_browser(spark, sf_dir):
    devices = broadcast_if_small(fx.devices(spark, sf_dir), fx.SMALL_DIM_ROWS)
    return fx.web_events(spark, sf_dir).join(devices, "device_id")


def device_datelist(spark, sf_dir):
    return dl.datelist_backfill(events_with_browser(spark, sf_dir), keys=["user_id", "browser_type"],
                                ts_col="event_time", lo=DAY_LO, hi=DAY_HI)


def q_bits_step(spark, sf_dir):
    """The last day's bit history from the stored one of the day before, with
    the active days of the last 7 and 28 read off the same integer."""
    ev = fx.web_events(spark, sf_dir)
    day = dt.date.fromisoformat(DAY_HI)
    prev = _stored(dl.bits_direct(ev, ts_col="event_time", lo=DAY_LO, hi=(day - dt.timedelta(days=1)).isoformat()))
    out = dl.bits_step(prev, ev, ts_col="event_time", day=DAY_HI)
    return out.select("user_id", "history_int", dl.recent_days(F.col("history_int"), 7).alias("days_of_7"),
                      dl.recent_days(F.col("history_int"), 28).alias("days_of_28"))


def q_device_datelist(spark, sf_dir):
    return _datelist_flat(device_datelist(spark, sf_dir), keys=("user_id", "browser_type"))


def q_device_datelist_map(spark, sf_dir):
    m = dl.datelist_map(device_datelist(spark, sf_dir))
    return _map_flat(m)


def _map_flat(m):
    flat = dl.datelist_unmap(m, keep=[F.size("dates_by_browser").alias("n_browsers")])
    return flat.select("user_id", "browser_type", "n_browsers", _dates_text().alias("dates_text"), "curr_date")


def _devices_until(ev):
    return _stored(dl.datelist_backfill(ev, keys=["user_id", "browser_type"], ts_col="event_time", lo=DAY_LO, hi=STEP_PREV))


def q_device_datelist_step(spark, sf_dir):
    ev = events_with_browser(spark, sf_dir)
    step = dl.datelist_step(_devices_until(ev), ev, keys=["user_id", "browser_type"], ts_col="event_time", day=STEP_DAY)
    return _datelist_flat(step, keys=("user_id", "browser_type"))


def q_device_datelist_map_step(spark, sf_dir):
    ev = events_with_browser(spark, sf_dir)
    return _map_flat(dl.datelist_map_step(dl.datelist_map(_devices_until(ev)), ev, key="user_id", map_key="browser_type",
                                          ts_col="event_time", day=STEP_DAY))


def q_bits_60_days(spark, sf_dir):
    """A history wider than 31 days, in the low 60 bits."""
    return dl.bits_direct(fx.web_events(spark, sf_dir), ts_col="event_time", lo="2023-12-03", hi=DAY_HI, width=60)


# --- facts ------------------------------------------------------------------

DEDUPE_KEYS = ["game_id", "team_id", "player_id"]
# Every non-key column, so the order is total and the survivor well defined.
DEDUPE_ORDER_COLS = ("l_partkey", "l_suppkey", "start_position", "comment", "min", "pts", "reb", "ast")


def dedupe_order():
    return [F.col(c).asc_nulls_first() for c in DEDUPE_ORDER_COLS]


def q_fct_game_details(spark, sf_dir):
    return fa.build_game_fact(fx.games(spark, sf_dir), fx.box_scores(spark, sf_dir))


def q_clock_to_seconds(spark, sf_dir):
    gd = fx.game_details(spark, sf_dir)
    return gd.select("game_id", "player_id", "l_partkey", "l_suppkey", "min",
                     clock_to_seconds("min").alias("seconds"))


def q_dedupe_first(spark, sf_dir):
    return fa.dedupe_first(fx.game_details(spark, sf_dir, grouped=True), DEDUPE_KEYS, dedupe_order())


def q_dedupe_extra_rows(spark, sf_dir):
    return fa.duplicates(fx.game_details(spark, sf_dir, grouped=True), DEDUPE_KEYS)


def q_duplicate_counts(spark, sf_dir):
    return fa.duplicate_counts(fx.game_details(spark, sf_dir, grouped=True), DEDUPE_KEYS)


def daily(spark, sf_dir):
    return fa.daily_metric(fx.web_events(spark, sf_dir), user_col="user_id", ts_col="event_time",
                           name="visited_home_page", cond=F.col("url") == "/")


def q_daily_metrics(spark, sf_dir):
    return daily(spark, sf_dir)


def q_metric_totals(spark, sf_dir):
    return fa.metric_totals(daily(spark, sf_dir))


def _monthly_flat(df):
    return df.select("user_id", "metric_name",
                     F.array_join(F.transform("metric_array", lambda x: F.coalesce(x.cast("string"), F.lit("-"))),
                                  ",").alias("metric_text"),
                     F.size("metric_array").alias("n_days"), "month_start")


def q_monthly_array_backfill(spark, sf_dir):
    return _monthly_flat(fa.monthly_array_backfill(daily(spark, sf_dir), month_start=DAY_LO, through=DAY_HI))


def q_monthly_array_step(spark, sf_dir):
    d = daily(spark, sf_dir)
    prev = _stored(fa.monthly_array_backfill(d, month_start=DAY_LO, through=STEP_PREV))
    return _monthly_flat(fa.monthly_array_step(prev, d, day=STEP_DAY, month_start=DAY_LO))


def q_monthly_array_rerun(spark, sf_dir):
    """The day's step run on a month that already holds the day: its slot is
    replaced, not appended.  (Rows without a user never meet a stored row.)"""
    d = daily(spark, sf_dir)
    known = d.where(F.col("user_id").isNotNull())
    prev = _stored(fa.monthly_array_backfill(known, month_start=DAY_LO, through=STEP_DAY))
    again = fa.monthly_array_step(prev, known, day=STEP_DAY, month_start=DAY_LO)
    alone = fa.monthly_array_backfill(d.where(F.col("user_id").isNull()), month_start=DAY_LO, through=STEP_DAY)
    return _monthly_flat(again.unionByName(alone))


def q_monthly_array_as_written(spark, sf_dir):
    """The script's stub: the month row holds only the day's value (the
    previous array is not carried; absent keys get [NULL])."""
    d = daily(spark, sf_dir)
    prev = fa.monthly_array_backfill(d, month_start=DAY_LO, through=STEP_PREV)
    return _monthly_flat(fa.monthly_array_step(prev, d, day=STEP_DAY, month_start=DAY_LO, as_written=True))


# --- analyses ---------------------------------------------------------------

def q_streak_top10(spark, sf_dir):
    return an.threshold_report(fx.player_seasons(spark, sf_dir), key="player_name", period="season",
                               value="pts", threshold=20, k=10)


def q_streak_true(spark, sf_dir):
    return an.longest_streaks(fx.player_seasons(spark, sf_dir), key="player_name", period="season",
                              value="pts", threshold=20, k=10)


def q_explode_history(spark, sf_dir):
    return an.explode_history(players_hist(spark, sf_dir, snapshots="last"), "seasons", ["player_name"])


def q_career_total(spark, sf_dir):
    rows = cu.players_cumulated(fx.player_seasons(spark, sf_dir), SEASON_LO, SEASON_HI, snapshots="last", attrs=(),
                                season_fields=("season", "pts", "gp"))
    return an.fold_array(rows, ["player_name"], ["pts", "gp"],
                         "seasons", F.lit(0.0), lambda acc, r: acc + r["pts"] * r["gp"], "total_points")


def q_dense_rank_global(spark, sf_dir):
    ps = fx.player_seasons(spark, sf_dir).select("player_name", "season", "pts")
    return an.dense_rank_all(ps, "pts")


def q_dense_rank_text(spark, sf_dir):
    """A text column with NULLs (ranked last), split into ranges."""
    gd = fx.game_details(spark, sf_dir).select("game_id", "player_id", "l_partkey", "l_suppkey", "comment")
    return an.dense_rank_all(gd, "comment", descending=False, small_values=1, ranges=4)


def q_dense_rank_dates(spark, sf_dir):
    ev = fx.web_events(spark, sf_dir).select("event_id", F.to_date("event_time").alias("day"))
    return an.dense_rank_all(ev, "day", small_values=5, ranges=4)


HOT_ROWS = 50     # low enough that the split path runs on any table


def q_running_sum_ties(spark, sf_dir):
    """Running totals over days: all events of a page and day share one order value."""
    ev = fx.web_events(spark, sf_dir).select("url", "event_id", F.to_date("event_time").alias("day"), "user_id")
    return running_total_of_ties(ev, key="url", order="day", value="user_id", out="running_users", hot_rows=HOT_ROWS)


SEGMENT = 20      # small, so that any table has users of several segments


def _event_segments(spark, sf_dir):
    return segments(fx.web_events(spark, sf_dir), keys=["user_id"], order=["event_time", "event_id"],
                    item_cols=["event_id", "url", "device_id"], size=SEGMENT, hot_rows=HOT_ROWS)


def q_event_segments(spark, sf_dir):
    """Every user's events in numbered segments; the NULL user is hot."""
    ids = F.transform("items", lambda x: x["event_id"].cast("string"))
    return _event_segments(spark, sf_dir).select("user_id", "segment", F.size("items").alias("n_events"),
                                                 F.array_join(ids, ",").alias("event_ids"))


def q_event_segments_fold(spark, sf_dir):
    """Values of whole histories, folded over their segments."""
    views = F.aggregate("items", F.lit(0).cast("bigint"), lambda a, x: a + (x["url"] == "/").cast("bigint"))
    return fold_segments(_event_segments(spark, sf_dir), keys=["user_id"],
                         per_segment={"n": F.size("items").cast("bigint"), "views": views,
                                      "last_device": F.element_at("items", -1)["device_id"]},
                         across={"n_events": F.sum("n"), "n_views": F.sum("views"), "n_segments": F.count(F.lit(1)),
                                 "last_device": F.max_by("last_device", "segment")})


def q_running_sum_hot(spark, sf_dir):
    """Few keys that hold all rows (pages), split into range chunks."""
    ev = fx.web_events(spark, sf_dir).select("url", "event_id", "event_time", "user_id")
    return running_total(ev, key="url", order="event_time", value="user_id", out="running_users", hot_rows=HOT_ROWS) \
        .select("url", "event_id", "user_id", "running_users")


def q_rank_hot(spark, sf_dir):
    """Events per user numbered; the NULL user is a hot key."""
    ev = fx.web_events(spark, sf_dir).select("user_id", "event_id")
    return rank_within(ev, key="user_id", order=["event_id"], out="event_no", kind="row_number", hot_rows=HOT_ROWS)


def q_column_profile(spark, sf_dir):
    return an.profile(q_scd2_backfill(spark, sf_dir), exact_distinct=True)


def _table_dir(spark, sf_dir, name):
    return pb.table_location(spark, sf_dir.rstrip("/").rsplit("/", 1)[-1], name)


def q_publish_twice_rows(spark, sf_dir):
    path = _table_dir(spark, sf_dir, "players_scd2")
    for _ in range(2):
        pb.publish(q_scd2_backfill(spark, sf_dir), path, ["current_season"])
    return pb.read_partition(spark, path, "current_season", SEASON_HI) \
        .select("player_name", "is_active", "start_season", "end_season", "current_season")


def q_rerun_publish(spark, sf_dir):
    """Every load run twice, with one day that has no rows the second time:
    that day's partition is replaced by an empty one."""
    path = _table_dir(spark, sf_dir, "daily_metric_rerun")
    rows, empty_day = daily(spark, sf_dir), dt.date(2024, 1, 15)
    pb.publish(rows, path, ["date", "metric_name"], replace_all=True)
    for _ in range(2):
        pb.publish(rows.where(F.col("date") != F.lit(empty_day)), path, ["date", "metric_name"])
        pb.publish(rows.where("false"), path, ["date", "metric_name"], partition={"date": empty_day})
    return spark.read.parquet(path).select("user_id", "metric_name", "metric_value", "date")


def q_require_previous(spark, sf_dir):
    """For each season: may it be loaded, i.e. is the season before stored?"""
    path = _table_dir(spark, sf_dir, "players_guard")
    pb.publish(q_cumulate_dim_backfill(spark, sf_dir), path, ["current_season"], replace_all=True)
    found = [(t, pb.has_partition(spark, path, "current_season", t - 1)) for t in range(SEASON_LO, SEASON_HI + 2)]
    return spark.createDataFrame(found, "current_season int, has_previous boolean")


def q_cumulate_dim_published(spark, sf_dir):
    """The incremental load as run in production: one job per season, each
    reading the stored previous snapshot (depends_on_past)."""
    path = _table_dir(spark, sf_dir, "players_cumulative")
    ps = fx.player_seasons(spark, sf_dir)

    def step(prev, t):
        cur = cu.period_items(ps.where(F.col("season") == t), keys=["player_name"], period="season",
                              item_cols=cu.SEASON_FIELDS, history_col="seasons", attrs=cu.PLAYER_ATTRS,
                              unique_per_period=True)
        return cu.cumulate_step(prev, cur, keys=["player_name"], period="season", history_col="seasons",
                                snapshot_col="current_season", attrs=cu.PLAYER_ATTRS,
                                since_col="years_since_last_active", keys_not_null=True)

    pb.load_periods(spark, path, "current_season", list(range(SEASON_LO, SEASON_HI + 1)), step)
    return _players_flat(pb.read_partition(spark, path, "current_season", SEASON_HI))


DAILY_SPEC = "user_id bigint, metric_name string, metric_value bigint, date date"


def q_daily_metrics_published(spark, sf_dir):
    """Reduced fact written with two partition columns (metric_name, date),
    conformed by name to its declared schema, re-published (idempotent) and
    read back through a range filter on the ``date`` partition column."""
    from pyspark.sql.types import _parse_datatype_string
    path = _table_dir(spark, sf_dir, "daily_metric_fact")
    spec = _parse_datatype_string(DAILY_SPEC)
    for _ in range(2):
        pb.publish(daily(spark, sf_dir), path, ["metric_name", "date"], spec=spec, not_null=["metric_name", "date"])
    t = spark.read.schema(spec).parquet(path).where(F.col("date").between(F.lit(DAY_LO).cast("date"), F.lit(DAY_HI).cast("date")))
    return t.select("user_id", "metric_name", "metric_value", "date")


def q_load_ledger(spark, sf_dir):
    """Games loaded season by season with a ledger.  The last season's load
    stops between data and ledger; afterwards the first season's input gets a
    new version.  Per season: rows loaded, whether it counts as loaded, and
    whether it must be loaded (again)."""
    path, ledger = _table_dir(spark, sf_dir, "games_by_season"), f"{_table_dir(spark, sf_dir, 'load_ledger')}-{uuid.uuid4().hex[:12]}"
    games = fx.games(spark, sf_dir)
    version = F.concat_ws("/", F.count(F.lit(1)), F.sum(F.col("game_id") % 1000))
    versions = _stored(games.groupBy("season").agg(version.alias("input_version")))
    seasons = sorted((r["season"], r["input_version"]) for r in versions.collect())       # bounded by the calendar
    before = None
    for t, v in seasons:
        rows = games.where(F.col("season") == t)
        if t == seasons[-1][0]:
            pb.publish(rows, path, ["season"], partition={"season": t})
        else:
            lg.load(rows, ledger, "games", path, "season", t, input_version=v, after=before)
        before = t
    now = versions.withColumn("input_version", F.when(F.col("season") == seasons[0][0], "corrected").otherwise(F.col("input_version")))
    have = lg.loaded(spark, ledger, "games").select(F.col("period").cast("int").alias("season"), "rows")
    missing = lg.missing(spark, ledger, "games", versions.select("season"), "season").withColumn("is_loaded", F.lit(False))
    again = lg.outdated(spark, ledger, "games", now, "season").select("season", F.lit(True).alias("load_again"))
    return (versions.select("season").join(have, "season", "left").join(missing, "season", "left").join(again, "season", "left")
                    .select("season", "rows", F.coalesce("is_loaded", F.lit(True)).alias("is_loaded"),
                            F.coalesce("load_again", F.lit(False)).alias("load_again")))


def q_missing_periods(spark, sf_dir):
    days = fx.web_events(spark, sf_dir).select(F.to_date("event_time").alias("date"))
    return pb.missing_periods(days, "date", sp.date_spine(spark, DAY_LO, DAY_HI))


def q_scd0_first(spark, sf_dir):
    """Type 0: the attribute as first recorded (here the player's college)."""
    return scd.scd0(fx.player_seasons(spark, sf_dir), keys=["player_name"], col="college", period="season")


def q_scd1_latest(spark, sf_dir):
    return scd.scd1(fx.player_seasons(spark, sf_dir), keys=["player_name"], col="pts", period="season")


def q_scd3_first_last(spark, sf_dir):
    return scd.scd3(fx.player_seasons(spark, sf_dir), keys=["player_name"], col="pts", period="season")


QUERIES = {
    "cumulate_dim_backfill": q_cumulate_dim_backfill,
    "cumulate_dim_step": q_cumulate_dim_step,
    "scd2_backfill": q_scd2_backfill,
    "scd2_increment": q_scd2_increment,
    "scd2_spine": q_scd2_spine,
    "scd2_increment_compat": q_scd2_increment_compat,
    "scd2_increment_null_ends": q_scd2_increment_null_ends,
    "scd2_actors_increment_compat": q_scd2_actors_increment_compat,
    "cumulate_actors_accumulate_step": q_cumulate_actors_accumulate_step,
    "cumulate_actors_replace_step": q_cumulate_actors_replace_step,
    "device_datelist_step": q_device_datelist_step,
    "device_datelist_map_step": q_device_datelist_map_step,
    "bits_60_days": q_bits_60_days,
    "monthly_array_rerun": q_monthly_array_rerun,
    "dense_rank_text": q_dense_rank_text,
    "dense_rank_dates": q_dense_rank_dates,
    "running_sum_hot": q_running_sum_hot,
    "rank_hot": q_rank_hot,
    "rerun_publish": q_rerun_publish,
    "require_previous": q_require_previous,
    "cumulate_actors_accumulate": q_cumulate_actors_accumulate,
    "cumulate_actors_replace": q_cumulate_actors_replace,
    "quality_class": q_quality_class,
    "scd2_actors_backfill": q_scd2_actors_backfill,
    "scd2_actors_backfill_compat": q_scd2_actors_backfill_compat,
    "scd2_actors_increment": q_scd2_actors_increment,
    "datelist_backfill": q_datelist_backfill,
    "datelist_step": q_datelist_step,
    "datelist_compact": q_datelist_compact,
    "datelist_bits": q_datelist_bits,
    "bits_direct": q_bits_direct,
    "device_datelist": q_device_datelist,
    "device_datelist_map": q_device_datelist_map,
    "fct_game_details": q_fct_game_details,
    "clock_to_seconds": q_clock_to_seconds,
    "dedupe_first": q_dedupe_first,
    "dedupe_extra_rows": q_dedupe_extra_rows,
    "duplicate_counts": q_duplicate_counts,
    "daily_metrics": q_daily_metrics,
    "metric_totals": q_metric_totals,
    "monthly_array_backfill": q_monthly_array_backfill,
    "monthly_array_step": q_monthly_array_step,
    "monthly_array_as_written": q_monthly_array_as_written,
    "streak_top10": q_streak_top10,
    "streak_true": q_streak_true,
    "explode_history": q_explode_history,
    "career_total": q_career_total,
    "dense_rank_global": q_dense_rank_global,
    "column_profile": q_column_profile,
    "publish_twice_rows": q_publish_twice_rows,
    "cumulate_dim_published": q_cumulate_dim_published,
    "missing_periods": q_missing_periods,
    "load_ledger": q_load_ledger,
    "scd2_late_periods": q_scd2_late_periods,
    "bits_step": q_bits_step,
    "running_sum_ties": q_running_sum_ties,
    "event_segments": q_event_segments,
    "event_segments_fold": q_event_segments_fold,
    "daily_metrics_published": q_daily_metrics_published,
    "scd0_first": q_scd0_first,
    "scd1_latest": q_scd1_latest,
    "scd3_first_last": q_scd3_first_last,
}
