"""Periodic loads as jobs: ``python -m dimforge.jobs <load> ...``, or on a
cluster ``spark-submit --py-files dimforge.zip dimforge/jobs.py <load> ...``.

Each load reads Parquet inputs, builds one period (or, with ``--full`` /
``backfill``, all periods in one job) and publishes it with a dynamic
partition overwrite, so re-running a period replaces it.  Incremental loads
read the stored previous partition and refuse to run when it is missing
(depends-on-past).  Target columns are matched by name to an existing
table's schema.  With ``--buckets N`` the cumulative loads write a catalog
table (``--table`` is its name) bucketed by the entity key, so each next
load joins the stored snapshot without shuffling it.

    players-cumulate  --seasons S --table T --period 1996 [--first] [--buckets N]
    players-backfill  --seasons S --table T --lo 1995 --hi 2001
    players-scd2      --cumulated C --table T --period 2002 [--full]
    actors-cumulate   --films F --table T --period 2000 [--first] [--mode replace|accumulate] [--buckets N]
    actors-scd2       --actors A --table T --period 2006 [--full]
    datelist          --events E --table T --day 2023-01-02 [--first] [--devices D] [--buckets N]
    datelist-bits     --datelist D --table T --day 2023-01-07 [--lo 2023-01-01] [--buckets N]
    daily-metric      --events E --table T [--day 2023-08-01]
    monthly-array     --daily D --table T --day 2023-08-02 --month-start 2023-08-01
    game-fact         --games G --details D --table T
    dedupe            --input I --table T --keys a,b,c --order x,y [--partition-by p]
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.operators import cumulate as cu
from dimforge.operators import datelist as dl
from dimforge.operators import facts as fa
from dimforge.operators import scd
from dimforge.operators.joins import broadcast_if_small
from dimforge.session import DEFAULT_CONF, shared_dir
from dimforge.sinks.publish import (MissingPartition, conform, has_partition, path_exists, publish, publish_table,
                                    read_partition, read_table_partition, require_previous)

# The full attribute / season-row column lists of the player
# table.  A load declares the ones it has (``attrs``, ``fields``; by default the
# lists of ``cumulate``); a declared column that is missing raises.
PLAYER_ATTRS_FULL = ("height", "college", "country", "draft_year", "draft_round", "draft_number")
SEASON_FIELDS_FULL = ("season", "age", "weight", "gp", "pts", "reb", "ast")


def _existing_schema(spark: SparkSession, table: str):
    return spark.read.parquet(table).schema if path_exists(spark, table) else None


def _publish(spark: SparkSession, df: DataFrame, table: str, partition_by, sort_within=(), partition=None,
             replace_all=False) -> None:
    """``partition``: the period this load owns, replaced also if it has no
    rows; ``replace_all``: the load owns the whole table."""
    spec = None if replace_all else _existing_schema(spark, table)
    if spec is not None:
        df = conform(df, spec)
    publish(df, table, partition_by, sort_within=sort_within, partition=partition, replace_all=replace_all)


def _prev(spark, table, column, value, buckets=None):
    if buckets:
        if not spark.catalog.tableExists(table) or \
                read_table_partition(spark, table, column, value).limit(1).count() == 0:
            raise MissingPartition(f"{table}: partition {column}={value} is missing")
        return read_table_partition(spark, table, column, value)
    require_previous(spark, table, column, value)
    return read_partition(spark, table, column, value)


def _store(spark, df, table, partition, buckets=None, bucket_key=None):
    """The one partition of a load, in a path table or (with ``buckets``) a
    catalog table bucketed by the entity key so the next load joins it without
    a shuffle."""
    if buckets:
        publish_table(df, table, list(partition), bucket_by=(buckets, bucket_key))
    else:
        _publish(spark, df, table, list(partition), partition=partition)


# --- players -------------------------------------------------------------------

def _player_rows(seasons: DataFrame, attrs=None, fields=None) -> tuple[DataFrame, list[str]]:
    attrs, fields = list(attrs or cu.PLAYER_ATTRS), list(fields or cu.SEASON_FIELDS)
    missing = [c for c in [*attrs, *fields] if c not in seasons.columns]
    if missing:
        raise ValueError(f"columns missing from the player seasons: {missing}")
    rows = cu.period_items(seasons, keys=["player_name"], period="season", item_cols=fields,
                           history_col="seasons", attrs=attrs, unique_per_period="check")
    return rows, attrs


def players_cumulate(spark, seasons_path, table, period, first=False, buckets=None, attrs=None, fields=None):
    seasons = spark.read.parquet(seasons_path).where(F.col("season") == period)
    rows, attrs = _player_rows(seasons, attrs, fields)
    prev = None if first else _prev(spark, table, "current_season", period - 1, buckets)
    out = cu.cumulate_step(prev, rows, keys=["player_name"], period="season", history_col="seasons",
                           snapshot_col="current_season", attrs=attrs, since_col="years_since_last_active")
    _store(spark, out, table, {"current_season": period}, buckets, ["player_name"])


def players_backfill(spark, seasons_path, table, lo, hi, attrs=None, fields=None):
    rows, attrs = _player_rows(spark.read.parquet(seasons_path), attrs, fields)
    out = cu.cumulate_backfill(rows, keys=["player_name"], period="season", history_col="seasons",
                               snapshot_col="current_season", lo=lo, hi=hi, attrs=attrs,
                               since_col="years_since_last_active")
    _publish(spark, out, table, ["current_season"])
    # seasons before the first one with rows: what an earlier run left there goes too
    first = rows.where(F.col("season").between(lo, hi)).agg(F.min("season")).first()[0]
    for t in range(lo, hi + 1 if first is None else first):
        if has_partition(spark, table, "current_season", t):
            _publish(spark, out.where("false"), table, ["current_season"], partition={"current_season": t})


def players_scd2(spark, cumulated_path, table, period, full=False):
    hist = spark.read.parquet(cumulated_path)
    if full:
        out = scd.scd2_backfill(hist, keys=["player_name"], state_cols=["is_active"], period="current_season",
                                as_of=period)
    else:
        out = scd.scd2_increment(_prev(spark, table, "current_season", period - 1), hist,
                                 keys=["player_name"], state_cols=["is_active"], t=period, period="current_season")
    # sorted by end: the next increment's open-run and closed-run reads skip each other's row groups
    _publish(spark, out, table, ["current_season"], sort_within=["end_season"], partition={"current_season": period})


# --- actors --------------------------------------------------------------------

ACTOR_SCD = dict(period="current_year", start_col="start_date", end_col="end_date", snapshot_col="current_year")


def actors_cumulate(spark, films_path, table, period, first=False, mode="replace", buckets=None):
    films = spark.read.parquet(films_path).where(F.col("year") == period)
    rows = cu.actor_period_rows(films)
    prev = None if first else _prev(spark, table, "current_year", period - 1, buckets)
    kw = {"latest": ["quality_class"]} if mode == "replace" else {"current": {"quality_class": "bad"}}
    out = cu.cumulate_step(prev, rows, keys=["actor_id"], period="year", history_col="films",
                           snapshot_col="current_year", attrs=["actor"], mode=mode, **kw)
    _store(spark, out, table, {"current_year": period}, buckets, ["actor_id"])


def actors_scd2(spark, actors_path, table, period, full=False):
    hist = spark.read.parquet(actors_path)
    kw = dict(keys=["actor_id"], state_cols=["quality_class", "is_active"], **ACTOR_SCD)
    if full:
        out = scd.scd2_backfill(hist, carry=["actor"], as_of=period, **kw)
    else:
        out = scd.scd2_increment(_prev(spark, table, "current_year", period - 1), hist, carried=["actor"],
                                 t=period, **kw)
    _publish(spark, out, table, ["current_year"], sort_within=["end_date"], partition={"current_year": period})


# --- activity ------------------------------------------------------------------

def datelist(spark, events_path, table, day, first=False, devices_path=None, buckets=None):
    events = spark.read.parquet(events_path)
    keys = ["user_id"]
    if devices_path:
        devices = spark.read.parquet(devices_path).select("device_id", "browser_type")
        events = events.join(broadcast_if_small(devices), "device_id")
        keys = ["user_id", "browser_type"]
    d = dt.date.fromisoformat(day)
    prev = None if first else _prev(spark, table, "curr_date", d - dt.timedelta(days=1), buckets)
    out = dl.datelist_step(prev, events, keys=keys, ts_col="event_time", day=day)
    _store(spark, out, table, {"curr_date": d}, buckets, keys)


def datelist_bits(spark, datelist_table, table, day, lo=None, buckets=None):
    """Bit history (last 31 days, bit 30 = ``day``) of the datelist snapshot
    of ``day``, written as one partition per snapshot day."""
    d = dt.date.fromisoformat(day)
    lo = lo or (d - dt.timedelta(days=30)).isoformat()
    snap = _prev(spark, datelist_table, "curr_date", d, buckets)
    keys = [c for c in ("user_id", "browser_type") if c in snap.columns]
    out = dl.datelist_bits(snap, keys=keys, lo=lo, hi=day).withColumn("curr_date", F.lit(d))
    _publish(spark, out, table, ["curr_date"], partition={"curr_date": d})


METRIC = "visited_home_page"


def daily_metric(spark, events_path, table, day=None):
    out = fa.daily_metric(spark.read.parquet(events_path), user_col="user_id", ts_col="event_time",
                          name=METRIC, cond=F.col("url") == "/", day_lo=day, day_hi=day)
    own = {"metric_name": METRIC, **({"date": dt.date.fromisoformat(day)} if day else {})}
    _publish(spark, out, table, ["metric_name", "date"], partition=own)


def monthly_array(spark, daily_path, table, day, month_start):
    """One day into the month's arrays.  The stored month, if there is one, is
    read whatever the day, so a day may be loaded again or late: the step
    replaces its slot.  The month is a partition of its own, read before it is
    replaced, so the new one is written through a checkpoint."""
    stored = has_partition(spark, f"{table}/metric_name={METRIC}", "month_start", month_start)
    daily = spark.read.parquet(daily_path).where(F.col("metric_name") == METRIC)
    prev, through = None, dt.date.fromisoformat(day)
    if stored:
        month = spark.read.parquet(table).where((F.col("metric_name") == METRIC) & (F.col("month_start") == month_start))
        prev = month.where(F.col("user_id").isNotNull())
        days = month.agg(F.max(F.size("metric_array"))).first()[0] or 1
        through = max(through, dt.date.fromisoformat(month_start) + dt.timedelta(days=days - 1))
    # a row without a user meets no stored one: these are made again from the days loaded so far
    known = fa.monthly_array_step(prev, daily.where(F.col("user_id").isNotNull()), day=day, month_start=month_start)
    alone = fa.monthly_array_backfill(daily.where(F.col("user_id").isNull()), month_start=month_start,
                                      through=through.isoformat())
    shared_dir(spark)
    out = known.unionByName(alone.select(*known.columns)).checkpoint()
    _publish(spark, out, table, ["metric_name", "month_start"],
             partition={"metric_name": METRIC, "month_start": dt.date.fromisoformat(month_start)})


# --- facts ---------------------------------------------------------------------

def _chosen(names, full):
    return None if names is None else {n: full[n] for n in names}


def game_fact(spark, games_path, details_path, table, measures=None, dimensions=None):
    """``measures`` / ``dimensions``: the box-score columns to take (default:
    all of them)."""
    out = fa.build_game_fact(spark.read.parquet(games_path), spark.read.parquet(details_path),
                             _chosen(measures, fa.GAME_MEASURES), _chosen(dimensions, fa.GAME_DIMENSIONS))
    _publish(spark, out, table, ["dim_season"])


def dedupe(spark, input_path, table, keys, order, partition_by=None):
    if input_path.rstrip("/") == table.rstrip("/"):
        raise ValueError("the input cannot be replaced while it is read: name another table")
    df = spark.read.parquet(input_path)
    out = fa.dedupe_first(df, keys, [F.col(c).asc_nulls_first() for c in order])
    if partition_by:
        _publish(spark, out, table, partition_by, replace_all=True)
    else:
        out.write.mode("overwrite").parquet(table)


def _int(v):
    return int(v) if v else None


def _names(v):
    return v.split(",") if v else None


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="dimforge.jobs", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = ap.add_subparsers(dest="load", required=True)

    def add(name, *opts):
        p = sub.add_parser(name)
        for o in opts:
            if o.startswith("?"):
                p.add_argument(f"--{o[1:]}", action="store_true")
            elif o.endswith("="):
                p.add_argument(f"--{o[:-1]}", default=None)
            elif o.endswith("#"):
                p.add_argument(f"--{o[:-1]}", type=int, required=True)
            else:
                p.add_argument(f"--{o}", required=True)
        return p

    add("players-cumulate", "seasons", "table", "period#", "?first", "buckets=", "attrs=", "fields=")
    add("players-backfill", "seasons", "table", "lo#", "hi#", "attrs=", "fields=")
    add("players-scd2", "cumulated", "table", "period#", "?full")
    add("actors-cumulate", "films", "table", "period#", "?first", "mode=", "buckets=")
    add("actors-scd2", "actors", "table", "period#", "?full")
    add("datelist", "events", "table", "day", "?first", "devices=", "buckets=")
    add("datelist-bits", "datelist", "table", "day", "lo=", "buckets=")
    add("daily-metric", "events", "table", "day=")
    add("monthly-array", "daily", "table", "day", "month-start")
    add("game-fact", "games", "details", "table", "measures=", "dimensions=")
    add("dedupe", "input", "table", "keys", "order", "partition-by=")
    a = ap.parse_args(argv)

    # The master and resources come from spark-submit; only the settings the
    # loads depend on are fixed here.
    spark = SparkSession.builder.appName(f"dimforge-{a.load}").getOrCreate()
    for k, v in DEFAULT_CONF.items():
        if k not in ("spark.ui.enabled", "spark.ui.showConsoleProgress"):
            spark.conf.set(k, v)
    if a.load == "players-cumulate":
        players_cumulate(spark, a.seasons, a.table, a.period, a.first, _int(a.buckets),
                         _names(a.attrs), _names(a.fields))
    elif a.load == "players-backfill":
        players_backfill(spark, a.seasons, a.table, a.lo, a.hi, _names(a.attrs), _names(a.fields))
    elif a.load == "players-scd2":
        players_scd2(spark, a.cumulated, a.table, a.period, a.full)
    elif a.load == "actors-cumulate":
        actors_cumulate(spark, a.films, a.table, a.period, a.first, a.mode or "replace", _int(a.buckets))
    elif a.load == "actors-scd2":
        actors_scd2(spark, a.actors, a.table, a.period, a.full)
    elif a.load == "datelist":
        datelist(spark, a.events, a.table, a.day, a.first, a.devices, _int(a.buckets))
    elif a.load == "datelist-bits":
        datelist_bits(spark, a.datelist, a.table, a.day, a.lo, _int(a.buckets))
    elif a.load == "daily-metric":
        daily_metric(spark, a.events, a.table, a.day)
    elif a.load == "monthly-array":
        monthly_array(spark, a.daily, a.table, a.day, a.month_start)
    elif a.load == "game-fact":
        game_fact(spark, a.games, a.details, a.table, _names(a.measures), _names(a.dimensions))
    elif a.load == "dedupe":
        dedupe(spark, a.input, a.table, a.keys.split(","), a.order.split(","),
               a.partition_by.split(",") if a.partition_by else None)


if __name__ == "__main__":
    main(sys.argv[1:])
