"""The periodic loads, run one period at a time through stored partitions,
equal the single-pass forms."""

from pyspark.sql import functions as F

from conftest import rows
from dimforge import jobs
from dimforge.operators import cumulate as cu
from dimforge.operators import datelist as dl
from dimforge.operators import scd
from dimforge.plans import catalog as c
from dimforge.sinks.publish import read_partition
from dimforge.sources import fixtures as fx


def test_player_loads_period_by_period(spark, sf_dir, tmp_path):
    seasons = str(tmp_path / "player_seasons")
    fx.player_seasons(spark, sf_dir).write.parquet(seasons)
    cum, scd_t = str(tmp_path / "players"), str(tmp_path / "players_scd")
    for t in range(1995, 2002):
        jobs.players_cumulate(spark, seasons, cum, t, first=(t == 1995))
    jobs.players_scd2(spark, cum, scd_t, 1998, full=True)
    for t in range(1999, 2002):
        jobs.players_scd2(spark, cum, scd_t, t)
    ps = spark.read.parquet(seasons)
    want = cu.players_cumulated(ps, 1995, 2001, snapshots="last")
    got = read_partition(spark, cum, "current_season", 2001)
    assert rows(got, want.columns) == rows(want)
    full = scd.scd2_backfill(spark.read.parquet(cum), keys=["player_name"], state_cols=["is_active"],
                             period="current_season", as_of=2001)
    assert rows(read_partition(spark, scd_t, "current_season", 2001), full.columns) == rows(full)
    # re-running a period changes nothing
    jobs.players_cumulate(spark, seasons, cum, 2001)
    assert spark.read.parquet(cum).where("current_season = 2001").count() == want.count()


def test_datelist_and_monthly_loads(spark, sf_dir, tmp_path):
    events = str(tmp_path / "web_events")
    fx.web_events(spark, sf_dir).write.parquet(events)
    table = str(tmp_path / "datelist")
    days = [f"2024-01-0{i}" for i in range(1, 6)]
    for d in days:
        jobs.datelist(spark, events, table, d, first=(d == days[0]))
    ev = spark.read.parquet(events)
    want = dl.datelist_backfill(ev, keys=["user_id"], ts_col="event_time", lo=days[0], hi=days[-1])
    got = read_partition(spark, table, "curr_date", F.lit(days[-1]).cast("date"))
    assert rows(got, ["user_id", "dates_active"]) == rows(want, ["user_id", "dates_active"])

    bits_t = str(tmp_path / "bits")
    jobs.datelist_bits(spark, table, bits_t, days[-1], lo=days[0])
    want_b = dl.bits_direct(ev, ts_col="event_time", lo=days[0], hi=days[-1])
    assert rows(spark.read.parquet(bits_t), want_b.columns) == rows(want_b)

    daily_t, monthly_t = str(tmp_path / "daily"), str(tmp_path / "monthly")
    jobs.daily_metric(spark, events, daily_t)
    for d in days:
        jobs.monthly_array(spark, daily_t, monthly_t, d, "2024-01-01")
    from dimforge.operators import facts as fa
    want_m = fa.monthly_array_backfill(spark.read.parquet(daily_t), month_start="2024-01-01", through=days[-1])
    got_m = spark.read.parquet(monthly_t)
    assert rows(got_m, ["user_id", "metric_name", "metric_array"]) == \
        rows(want_m, ["user_id", "metric_name", "metric_array"])


def test_fact_and_dedupe_jobs(spark, sf_dir, tmp_path):
    g, d = str(tmp_path / "games"), str(tmp_path / "details")
    fx.games(spark, sf_dir).write.parquet(g)
    fx.game_details(spark, sf_dir).write.parquet(d)
    fact, dd = str(tmp_path / "fct"), str(tmp_path / "dedup")
    jobs.game_fact(spark, g, d, fact, ["reb", "ast", "pts"], ["start_position"])
    assert spark.read.parquet(fact).count() == c.q_fct_game_details(spark, sf_dir).count()
    jobs.dedupe(spark, d, dd, c.DEDUPE_KEYS, list(c.DEDUPE_ORDER_COLS))
    assert rows(spark.read.parquet(dd)) == rows(c.q_dedupe_first(spark, sf_dir))


def test_command_line_entry(spark, sf_dir, tmp_path):
    g, d = str(tmp_path / "games"), str(tmp_path / "details")
    fx.games(spark, sf_dir).write.parquet(g)
    fx.game_details(spark, sf_dir).write.parquet(d)
    out = str(tmp_path / "fct")
    jobs.main(["game-fact", "--games", g, "--details", d, "--table", out, "--measures", "reb,ast,pts",
               "--dimensions", "start_position"])
    assert spark.read.parquet(out).count() == spark.read.parquet(d).count()


def test_bucketed_cumulative_job(spark, sf_dir, tmp_path):
    import uuid
    seasons = str(tmp_path / "player_seasons")
    fx.player_seasons(spark, sf_dir).write.parquet(seasons)
    name = f"players_job_{uuid.uuid4().hex[:8]}"
    for t in range(1995, 1999):
        jobs.main(["players-cumulate", "--seasons", seasons, "--table", name, "--period", str(t),
                   "--buckets", "8"] + (["--first"] if t == 1995 else []))
    want = cu.players_cumulated(spark.read.parquet(seasons), 1995, 1998, snapshots="last")
    got = spark.table(name).where("current_season = 1998")
    assert rows(got, want.columns) == rows(want)
    spark.sql(f"DROP TABLE {name}")


def test_actor_loads_period_by_period(spark, sf_dir, tmp_path):
    films = str(tmp_path / "actor_films")
    fx.actor_films(spark, sf_dir).write.parquet(films)
    cum, scd_t = str(tmp_path / "actors"), str(tmp_path / "actors_scd")
    for t in range(1995, 1999):
        jobs.actors_cumulate(spark, films, cum, t, first=(t == 1995))
    jobs.actors_scd2(spark, cum, scd_t, 1997, full=True)
    jobs.actors_scd2(spark, cum, scd_t, 1998)
    af = spark.read.parquet(films)
    want = cu.actors_cumulated(af, 1995, 1998, mode="replace", snapshots="last")
    assert rows(read_partition(spark, cum, "current_year", 1998), want.columns) == rows(want)
    full = scd.scd2_backfill(spark.read.parquet(cum), keys=["actor_id"], carry=["actor"],
                             state_cols=["quality_class", "is_active"], as_of=1998, **c.ACTOR_SCD)
    assert rows(read_partition(spark, scd_t, "current_year", 1998), full.columns) == rows(full)
