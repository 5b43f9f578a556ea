"""Behaviour where the modelling scripts are surprising, on literal rows."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from dimforge.functions.bits import popcount32
from dimforge.functions.scalars import band, clock_to_seconds
from dimforge.operators import cumulate as cu
from dimforge.operators import datelist as dl
from dimforge.operators import facts as fa
from dimforge.operators import scd
from dimforge.sinks.publish import conform


def test_struct_fields_are_matched_by_name(spark):
    """Rows built as (pts, ast, reb) land in a (pts, reb, ast) spec by name."""
    df = spark.createDataFrame([(1, [(20.0, 3.0, 9.0)])],
                               "id int, seasons array<struct<pts:double,ast:double,reb:double>>")
    spec = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("seasons", T.ArrayType(T.StructType([
        T.StructField("pts", T.DoubleType()), T.StructField("reb", T.DoubleType()), T.StructField("ast", T.DoubleType())])))])
    out = conform(df, spec).first()
    assert out.seasons[0].reb == 9.0 and out.seasons[0].ast == 3.0


def test_clock_text_without_colon_is_taken_as_it_stands(spark):
    df = spark.createDataFrame([("12:30",), ("12",), (None,), ("0:59",)], "m string")
    assert [r[0] for r in df.select(clock_to_seconds("m")).collect()] == [750, 12, None, 59]


def test_band_edges_and_null(spark):
    df = spark.createDataFrame([(8.0,), (8.1,), (7.0,), (6.5,), (None,)], "r double")
    assert [r[0] for r in df.select(band("r")).collect()] == ["good", "star", "average", "average", "bad"]


def test_null_team_counts_as_visitor(spark):
    games = spark.createDataFrame([(1, dt.date(2020, 1, 1), 2020, 1, 5)],
                                  "game_id bigint, game_date_est date, season int, home_team_wins int, home_team_id bigint")
    details = spark.createDataFrame([(1, 5, 1, None, "10:00", 3), (1, None, 2, "DND", "5", 0)],
                                    "game_id bigint, team_id bigint, player_id bigint, comment string, min string, pts int")
    out = {r.player_id: r for r in fa.build_game_fact(games, details, {}, {}).collect()}
    assert out[1].dim_team_did_win is True and out[2].dim_team_did_win is False
    assert out[1].dim_did_not_dress is None and out[2].dim_did_not_dress is True
    assert out[2].m_seconds_played == 5


def test_inactive_datelist_slot_is_null_and_popcount_ignores_it(spark):
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5)), (1, dt.datetime(2024, 1, 3, 5))],
                               "user_id bigint, ts timestamp_ntz")
    d = dl.datelist_backfill(ev, keys=["user_id"], ts_col="ts", lo="2024-01-01", hi="2024-01-04").first()
    assert d.dates_active == [None, dt.date(2024, 1, 3), None, dt.date(2024, 1, 1)]
    b = dl.datelist_bits(dl.datelist_backfill(ev, keys=["user_id"], ts_col="ts", lo="2024-01-01", hi="2024-01-04"),
                         lo="2024-01-01", hi="2024-01-04").first()
    assert b.history_int == (1 << 29) + (1 << 27) and b.num_days_active == 2 and b.hist_in_binary == "101" + "0" * 27
    compact = dl.datelist_backfill(ev, keys=["user_id"], ts_col="ts", lo="2024-01-01", hi="2024-01-04",
                                   pad_nulls=False).first()
    assert compact.dates_active == [dt.date(2024, 1, 3), dt.date(2024, 1, 1)]


def test_popcount_is_32_bit(spark):
    df = spark.createDataFrame([(-1,), (5,)], "x bigint")
    assert [r[0] for r in df.select(popcount32(F.col("x"))).collect()] == [32, 2]


def test_monthly_array_as_written_keeps_one_element(spark):
    daily = spark.createDataFrame([(1, "m", 3, dt.date(2023, 8, 2)), (2, "m", 4, dt.date(2023, 8, 1))],
                                  "user_id bigint, metric_name string, metric_value bigint, date date")
    day1 = fa.monthly_array_step(None, daily, day="2023-08-01", month_start="2023-08-01")
    stub = fa.monthly_array_step(day1, daily, day="2023-08-02", month_start="2023-08-01", as_written=True)
    assert rows(stub, ["user_id", "metric_array"]) == [(1, (3,)), (2, (None,))]
    real = fa.monthly_array_step(day1, daily, day="2023-08-02", month_start="2023-08-01")
    assert rows(real, ["user_id", "metric_array"]) == [(1, (0, 3)), (2, (4, 0))]


def test_v1_inactive_year_is_bad_v2_carries(spark):
    films = spark.createDataFrame([("A", "a1", "F1", 2000, 10, 9.0, "f1")],
                                  "actor string, actor_id string, film string, year int, votes int, rating double, film_id string")
    acc = cu.actors_cumulated(films, 2000, 2001, mode="accumulate", snapshots="last").first()
    rep = cu.actors_cumulated(films, 2000, 2001, mode="replace", snapshots="last").first()
    assert (acc.quality_class, acc.is_active) == ("bad", False)
    assert (rep.quality_class, rep.is_active) == ("star", False)


def test_scd2_null_state_compat_carries_without_extending(spark):
    prev = spark.createDataFrame([("p", None, 2000, 2000)], "k string, s boolean, start_season int, end_season int")
    cur = spark.createDataFrame([("p", True, 2001)], "k string, s boolean, current_season int")
    compat = scd.scd2_increment(prev, cur, keys=["k"], state_cols=["s"], t=2001, period="current_season", compat=True)
    assert rows(compat, ["s", "start_season", "end_season"]) == [(True, 2000, 2000)]
    default = scd.scd2_increment(prev, cur, keys=["k"], state_cols=["s"], t=2001, period="current_season")
    assert rows(default, ["s", "start_season", "end_season"]) == sorted([(None, 2000, 2000), (True, 2001, 2001)],
                                                                        key=repr)


def test_first_load_and_empty_period(spark):
    ps = spark.createDataFrame([("a", 2000, 1)], "player_name string, season int, gp int")
    cur = cu.period_items(ps, keys=["player_name"], period="season", item_cols=["season", "gp"],
                          history_col="seasons", unique_per_period=True)
    first = cu.cumulate_step(None, cur, keys=["player_name"], period="season", history_col="seasons",
                             snapshot_col="current_season", since_col="since")
    empty = cur.where("false")
    nxt = cu.cumulate_step(first, empty, keys=["player_name"], period="season", history_col="seasons",
                           snapshot_col="current_season", since_col="since").first()
    assert (nxt.is_active, nxt.since, nxt.current_season, len(nxt.seasons)) == (False, 1, 2001, 1)


def test_scd2_open_end_null_option(spark):
    hist = spark.createDataFrame([("a", 2000, True), ("a", 2001, False), ("a", 2002, False)],
                                 "k string, p int, s boolean")
    kw = dict(keys=["k"], state_cols=["s"], period="p", as_of=2002, start_col="b", end_col="e", snapshot_col="snap")
    assert rows(scd.scd2_backfill(hist, **kw), ["s", "b", "e"]) == [(False, 2001, 2002), (True, 2000, 2000)]
    assert rows(scd.scd2_backfill(hist, open_end="null", **kw), ["s", "b", "e"]) == \
        sorted([(False, 2001, None), (True, 2000, 2000)], key=repr)


def test_duplicate_period_rows_are_refused(spark):
    ps = spark.createDataFrame([("a", 2000, 1), ("a", 2000, 2)], "player_name string, season int, gp int")
    try:
        cu.period_items(ps, keys=["player_name"], period="season", item_cols=["season", "gp"],
                        history_col="seasons", unique_per_period="check")
        raise AssertionError("duplicate (player, season) not detected")
    except cu.DuplicatePeriodRows:
        pass
    # pre-aggregating instead keeps both rows as items of one period
    agg = cu.period_items(ps, keys=["player_name"], period="season", item_cols=["season", "gp"],
                          history_col="seasons").first()
    assert len(agg.seasons) == 2


def test_publish_table_conforms_by_name_and_checks_not_null(spark):
    import uuid
    from pyspark.sql.types import _parse_datatype_string
    from dimforge.sinks.publish import publish_table
    name = f"t_{uuid.uuid4().hex[:8]}"
    spec = _parse_datatype_string("k string, v bigint, p int")
    publish_table(spark.createDataFrame([(1, "a", 1)], "v int, k string, p int"), name, ["p"], spec=spec)
    publish_table(spark.createDataFrame([(2, "b", 2)], "v int, k string, p int"), name, ["p"], spec=spec)
    publish_table(spark.createDataFrame([(3, "c", 2)], "v int, k string, p int"), name, ["p"], spec=spec)
    assert rows(spark.table(name), ["k", "v", "p"]) == [("a", 1, 1), ("c", 3, 2)]
    try:
        publish_table(spark.createDataFrame([(None, "z", 3)], "v int, k string, p int"), name, ["p"],
                      spec=spec, not_null=["v"])
        raise AssertionError("NULL in a NOT NULL column was accepted")
    except Exception as e:  # noqa: BLE001 - raised by the written plan
        assert "NULL in NOT NULL column v" in str(e)
    spark.sql(f"DROP TABLE {name}")


def test_profile_approximate_and_exact(spark):
    from dimforge.operators.analysis import profile
    df = spark.createDataFrame([(1, "x"), (2, None), (2, "y")], "a int, b string")
    exact = {r.column_name: r for r in profile(df, exact_distinct=True).collect()}
    approx = {r.column_name: r for r in profile(df).collect()}
    assert (exact["a"].n_rows, exact["a"].n_distinct, exact["a"].min_value, exact["a"].max_value) == (3, 2, "1", "2")
    assert (exact["b"].n_nulls, exact["b"].n_distinct) == (1, 2)
    assert approx["a"].n_distinct == 2 and approx["b"].n_distinct == 2


def test_missing_periods_none_missing(spark):
    from dimforge.sinks.publish import missing_periods
    from dimforge.sources.spine import date_spine
    have = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3)], "date date")
    assert missing_periods(have, "date", date_spine(spark, "2024-01-01", "2024-01-03")).count() == 0
    assert [r.date for r in missing_periods(have, "date", date_spine(spark, "2024-01-01", "2024-01-05"))
            .orderBy("date").collect()] == [dt.date(2024, 1, 4), dt.date(2024, 1, 5)]


def test_views_can_be_queried_with_sql(spark, sf_dir):
    from dimforge.sources.fixtures import register_views
    register_views(spark, sf_dir)
    n = spark.sql("""
        SELECT count(*) FROM (
          SELECT game_id, team_id, player_id,
                 row_number() OVER (PARTITION BY game_id, team_id, player_id ORDER BY l_partkey, l_suppkey) AS rn
          FROM game_details) WHERE rn = 1""").first()[0]
    assert n == spark.table("game_details").select("game_id", "team_id", "player_id").distinct().count()
