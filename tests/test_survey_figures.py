"""Figures measured independently at sf0.01 (recorded in FIXTURES.md /
"""

import pytest
from pyspark.sql import functions as F

from dimforge.operators import cumulate as cu
from dimforge.operators import datelist as dl
from dimforge.operators import facts as fa
from dimforge.operators import scd
from dimforge.plans import catalog as c
from dimforge.sources import fixtures as fx

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def players(spark):
    return cu.players_cumulated(fx.player_seasons(spark, SF01), 1995, 2001).cache()


def test_cumulated_rows_per_season(players):
    got = {r.current_season: r["count"] for r in players.groupBy("current_season").count().collect()}
    assert [got[y] for y in range(1995, 2002)] == [1174, 1429, 1480, 1491, 1496, 1497, 1500]
    active = {r.current_season: r["count"] for r in players.where("is_active").groupBy("current_season").count().collect()}
    assert [active[y] for y in range(1995, 2002)] == [1174, 1168, 1177, 1146, 1180, 1165, 885]


def test_scd2_snapshot_sizes(players):
    sizes = [scd.scd2_backfill(players, keys=["player_name"], state_cols=["is_active"], period="current_season",
                               as_of=t).count() for t in range(1997, 2002)]
    assert sizes == [2183, 2684, 3216, 3711, 4391]


def test_spine_scd2(spark):
    s = scd.scd2_from_spine(fx.player_seasons(spark, SF01), keys=["player_name"], period="season", lo=1995, hi=2001)
    assert s.count() == 4717 and s.where("NOT is_active").count() == 2079


def test_activity_figures(spark):
    ev = fx.web_events(spark, SF01)
    assert ev.where(F.col("user_id").isNull()).count() == 104
    days = [f"2024-01-0{i}" for i in range(1, 8)]
    per_day = [dl.datelist_backfill(ev, keys=["user_id"], ts_col="event_time", lo=days[0], hi=d).count()
               for d in days]
    assert per_day == [135, 151, 153, 154, 155, 156, 157]
    bits = dl.bits_direct(ev, ts_col="event_time", lo=days[0], hi=days[-1])
    assert bits.count() == 151
    assert bits.agg(F.max("history_int")).first()[0] == 2130706432
    ewb = c.events_with_browser(spark, SF01).where(F.to_date("event_time").between(days[0], days[-1]))
    assert ewb.select("user_id", "browser_type").distinct().count() == 722     # NULL user counted as a value
    pairs = dl.datelist_backfill(ewb, keys=["user_id", "browser_type"], ts_col="event_time", lo=days[0],
                                 hi=days[-1], null_keys="drop")
    null_pairs = ewb.where(F.col("user_id").isNull()).select("browser_type").distinct().count()
    assert pairs.count() == 722 - null_pairs


def test_fact_figures(spark):
    d = c.daily(spark, SF01)
    assert d.count() == 4025 and d.agg(F.sum("metric_value")).first()[0] == 1982
    gd = fx.game_details(spark, SF01)
    assert gd.count() == 60000
    assert fa.dedupe_first(gd, c.DEDUPE_KEYS, c.dedupe_order()).count() == 45832


def test_actor_namesakes(spark):
    af = fx.actor_films(spark, SF01)
    shared = af.select("actor", "actor_id").distinct().groupBy("actor").count().where("count = 2").count()
    assert shared == 100 and af.select("actor").distinct().count() == 1400
