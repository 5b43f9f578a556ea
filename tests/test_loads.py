"""Loads that run again, start late, or have nothing to load; caps that raise."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from dimforge.operators import analysis as an
from dimforge.operators import cumulate as cu
from dimforge.operators import datelist as dl
from dimforge.operators import facts as fa
from dimforge.operators import scd
from dimforge.plans import catalog as c
from dimforge.sinks import publish as pb
from dimforge.sources import fixtures as fx

SCD = ["player_name", "is_active", "start_season", "end_season"]


@pytest.mark.parametrize("open_end", ["period", "null"])
def test_increment_chain_equals_full_load(spark, sf_dir, open_end):
    hist = c.players_activity(spark, sf_dir).checkpoint()
    kw = dict(keys=["player_name"], state_cols=["is_active"], period="current_season", open_end=open_end)
    snap = scd.scd2_backfill(hist, as_of=1997, **kw)
    for t in range(1998, 2002):
        snap = scd.scd2_increment(snap, hist, t=t, **kw).checkpoint()
    assert rows(snap, SCD) == rows(scd.scd2_backfill(hist, as_of=2001, **kw), SCD)


def test_increment_carries_every_unmatched_row(spark):
    prev = spark.createDataFrame([("a", True, 1, None), ("b", True, 1, 2), ("b", False, 5, 9), ("gone", True, 1, 2)],
                                 "k string, s boolean, start_season int, end_season int")
    cur = spark.createDataFrame([("a", True, 3), ("b", False, 3), ("new", True, 3)], "k string, s boolean, p int")
    got = scd.scd2_increment(prev, cur, keys=["k"], state_cols=["s"], t=3, period="p")
    assert rows(got, ["k", "s", "start_season", "end_season"]) == sorted(
        [("a", True, 1, 3), ("b", True, 1, 2), ("b", False, 3, 3), ("b", False, 5, 9), ("gone", True, 1, 2), ("new", True, 3, 3)], key=repr)


def test_null_keys_step_equals_backfill(spark):
    raw = spark.createDataFrame([(None, 1, "x"), (None, 2, "y"), ("a", 1, "z"), ("a", 2, "w")], "k string, p int, v string")
    items = cu.period_items(raw, keys=["k"], period="p", item_cols=["v"], history_col="h", unique_per_period=True)
    kw = dict(keys=["k"], period="p", history_col="h", snapshot_col="snap")
    first = cu.cumulate_step(None, items.where("p = 1"), **kw).checkpoint()
    step = cu.cumulate_step(first, items.where("p = 2"), **kw)
    back = cu.cumulate_backfill(items, lo=1, hi=2, snapshots="last", **kw)
    assert rows(step, ["k", "h", "is_active", "snap"]) == rows(back, ["k", "h", "is_active", "snap"])


def test_monthly_step_replaces_a_day_and_refuses_a_gap(spark):
    day = lambda d, v: (1, "m", v, dt.date(2024, 1, d))
    daily = spark.createDataFrame([day(1, 3), day(2, 4), day(3, 5)], "user_id bigint, metric_name string, metric_value bigint, date date")
    kw = dict(month_start="2024-01-01")
    one = fa.monthly_array_step(None, daily, day="2024-01-01", **kw).checkpoint()
    two = fa.monthly_array_step(one, daily, day="2024-01-02", **kw).checkpoint()
    again = fa.monthly_array_step(two, daily, day="2024-01-02", **kw).checkpoint()
    assert [r.metric_array for r in again.collect()] == [[3, 4]]
    assert [r.metric_array for r in fa.monthly_array_step(two, daily, day="2024-01-01", **kw).collect()] == [[3, 4]]
    with pytest.raises(Exception, match="holds 1 days"):
        fa.monthly_array_step(one, daily, day="2024-01-03", **kw).collect()


def test_empty_partition_and_whole_table_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 10), (2, 20)], "v int, p int")
    pb.publish(df, path, ["p"])
    pb.publish(df.where("false"), path, ["p"], partition={"p": 10})
    assert rows(spark.read.parquet(path), ["v", "p"]) == [(2, 20)]
    assert pb.has_partition(spark, path, "p", 10) and not pb.has_partition(spark, path, "p", 30)
    pb.publish(df.where("p = 10"), path, ["p"], replace_all=True)
    assert rows(spark.read.parquet(path), ["v", "p"]) == [(1, 10)]


def test_load_periods_from_a_stored_past_and_over_an_empty_day(spark, tmp_path):
    path = str(tmp_path / "t")
    step = lambda prev, p: (prev.select("v") if prev is not None else spark.createDataFrame([], "v int")) \
        .unionByName(spark.range(1 if p != 2 else 0).select(F.lit(p).alias("v"))).withColumn("p", F.lit(p))
    pb.load_periods(spark, path, "p", [0], lambda prev, p: spark.createDataFrame([], "v int, p int"))
    pb.load_periods(spark, path, "p", [1, 2, 3], step, past=0)
    assert rows(pb.read_partition(spark, path, "p", 3), ["v"]) == [(1,), (3,)]
    with pytest.raises(pb.MissingPartition):
        pb.load_periods(spark, path, "p", [9], step, past=8)


def test_bit_width_is_checked_and_counted(spark):
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i in range(40)], "user_id int, ts timestamp")
    kw = dict(ts_col="ts", lo="2024-01-01", hi="2024-02-09")
    with pytest.raises(ValueError):
        dl.bits_direct(ev, **kw)
    with pytest.raises(ValueError):
        dl.bits_direct(ev, width=64, **kw)
    assert dl.bits_direct(ev, width=45, **kw).first().num_days_active == 40


def test_dense_rank_of_text_and_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "v string")
    want = [("a", 3), ("b", 2), ("b", 2), ("c", 1), (None, 4)]
    for small in (100, 1):
        assert rows(an.dense_rank_all(df, "v", small_values=small, ranges=2), ["v", "ranking"]) == sorted(want, key=repr)
    assert rows(an.dense_rank_topk(df, "v", 2), ["v", "ranking"]) == [("b", 2), ("b", 2), ("c", 1)]


def test_map_form_keeps_null_keys_and_null_map_keys(spark):
    ev = spark.createDataFrame([(None, "x", dt.datetime(2024, 1, 1)), (1, None, dt.datetime(2024, 1, 1)), (1, "y", dt.datetime(2024, 1, 1))],
                               "u int, b string, ts timestamp")
    one = dl.datelist_map_step(None, ev, key="u", map_key="b", ts_col="ts", day="2024-01-01")
    assert sorted((r.u is None, sorted(r.dates_by_browser)) for r in one.collect()) == [(False, ["", "y"]), (True, ["x"])]
    assert dl.datelist_map_step(None, ev, key="u", map_key="b", ts_col="ts", day="2024-01-01", null_keys="drop").count() == 1


def test_missing_fact_columns_raise(spark, sf_dir):
    with pytest.raises(ValueError, match="plus_minus"):
        fa.build_game_fact(fx.games(spark, sf_dir), fx.game_details(spark, sf_dir))
