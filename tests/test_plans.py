"""Physical-plan shapes the scale design depends on."""

import re

from pyspark.sql import functions as F

from dimforge.operators import cumulate as cu
from dimforge.operators import datelist as dl
from dimforge.operators import scd
from dimforge.plans import catalog as c
from dimforge.plans import constructs as k
from dimforge.sinks import publish as pb
from dimforge.sources import fixtures as fx
from conftest import rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(p: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|"
                          r"Exchange RoundRobinPartitioning", p))


def test_dedupe_limits_before_the_shuffle(spark, sf_dir, tmp_path):
    from dimforge.operators import facts as fa
    path = str(tmp_path / "details")
    fx.game_details(spark, sf_dir).write.parquet(path)
    p = plan(fa.dedupe_first(spark.read.parquet(path), c.DEDUPE_KEYS, c.dedupe_order()))
    assert p.count("WindowGroupLimit") == 2          # partial (map side) + final
    assert shuffles(p) == 1
    # on the fixture the join already clusters by game_id: no extra shuffle at all
    base = fx.game_details(spark, sf_dir)
    assert shuffles(plan(c.q_dedupe_first(spark, sf_dir))) <= shuffles(plan(base)) + 1


def test_top_k_report_has_no_single_partition_shuffle(spark, sf_dir):
    p = plan(c.q_streak_top10(spark, sf_dir))
    assert "SinglePartition" not in p
    assert "TakeOrderedAndProject" in p


def test_scd2_backfill_from_stored_table_shuffles_once(spark, sf_dir, tmp_path):
    path = str(tmp_path / "players")
    pb.publish(c.players_hist(spark, sf_dir), path, ["current_season"])
    hist = spark.read.parquet(path)
    p = plan(scd.scd2_backfill(hist, keys=["player_name"], state_cols=["is_active"], period="current_season",
                               as_of=c.SEASON_HI))
    assert shuffles(p) == 1
    assert "ReadSchema: struct<player_name:string,is_active:boolean>" in p   # the arrays are never read
    assert "PartitionFilters: [isnotnull(current_season" in p


def test_backfills_shuffle_once(spark, sf_dir):
    ev = fx.web_events(spark, sf_dir)
    assert shuffles(plan(dl.datelist_backfill(ev, keys=["user_id"], ts_col="event_time", lo=c.DAY_LO,
                                              hi=c.DAY_HI, snapshots="all"))) == 1
    ps = fx.player_seasons(spark, sf_dir)
    spine = plan(scd.scd2_from_spine(ps, keys=["player_name"], period="season", lo=1995, hi=2001))
    base = plan(ps)
    assert shuffles(spine) == shuffles(base) + 1


def test_day_filter_is_pushed_to_the_scan(spark, sf_dir):
    p = plan(k.q_day_filter(spark, sf_dir))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-07T00:00\)", p)


def test_bit_history_aggregates_before_the_shuffle(spark, sf_dir):
    p = plan(c.q_bits_direct(spark, sf_dir))
    assert "partial_bit_or" in p and shuffles(p) == 1


def test_cumulate_backfill_prunes_history_for_scd(spark, sf_dir):
    """SCD2 over the in-memory cumulated table never builds the seasons array."""
    hist = cu.players_cumulated(fx.player_seasons(spark, sf_dir), 1995, 2001)
    p = plan(scd.scd2_backfill(hist, keys=["player_name"], state_cols=["is_active"], period="current_season",
                               as_of=2001))
    assert "flatten" not in p and "reverse" not in p


def test_broadcast_only_for_bounded_dimensions(spark, sf_dir):
    p = plan(fx.player_seasons(spark, sf_dir).where(F.col("season") == 2000))
    assert "BroadcastHashJoin" in p


def test_bucketed_snapshot_is_not_reshuffled_by_the_next_load(spark, sf_dir):
    """Cumulative loads into a table bucketed by entity: the step joins the
    stored previous snapshot without an exchange on its side, and the
    result equals the single-pass form."""
    import uuid
    name = f"players_bucketed_{uuid.uuid4().hex[:8]}"
    ps = fx.player_seasons(spark, sf_dir)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def cur(t):
        return cu.period_items(ps.where(F.col("season") == t), keys=["player_name"], period="season",
                               item_cols=cu.SEASON_FIELDS, history_col="seasons", attrs=cu.PLAYER_ATTRS,
                               unique_per_period=True)

    step_kw = dict(keys=["player_name"], period="season", history_col="seasons", snapshot_col="current_season",
                   attrs=cu.PLAYER_ATTRS, since_col="years_since_last_active")
    pb.publish_table(cu.cumulate_step(None, cur(1995), **step_kw), name, ["current_season"],
                     bucket_by=(n, ["player_name"]))
    for t in range(1996, 2002):
        step = cu.cumulate_step(pb.read_table_partition(spark, name, "current_season", t - 1), cur(t), **step_kw)
        if t == 2001:
            p = plan(step)
            scans = [line for line in p.split("\n") if "FileScan" in line and name in line]
            assert any("Bucketed: true" in line for line in scans)      # the joined snapshot keeps its buckets
            # the only shuffle on the entity key is the new period's, into the table's buckets
            assert len(re.findall(r"Exchange hashpartitioning\(player_name#\d+, " + str(n) + r"\)", p)) == 1
        pb.publish_table(step, name, ["current_season"])
    got = pb.read_table_partition(spark, name, "current_season", 2001)
    want = cu.players_cumulated(ps, 1995, 2001, snapshots="last")
    from conftest import rows
    assert rows(got, want.columns) == rows(want)
    spark.sql(f"DROP TABLE {name}")


def test_explode_of_few_fields_prunes_nested_columns(spark, sf_dir, tmp_path):
    from dimforge.operators import analysis as an
    path = str(tmp_path / "players")
    cu.players_cumulated(fx.player_seasons(spark, sf_dir), 1995, 2001, snapshots="last").write.parquet(path)
    dim = spark.read.parquet(path)
    p = plan(an.explode_history(dim, "seasons", ["player_name"], fields=["season", "pts"]))
    assert "ReadSchema: struct<player_name:string,seasons:array<struct<season:int,pts:double>>>" in p
    full = an.explode_history(dim, "seasons", ["player_name"])
    assert rows(an.explode_history(dim, "seasons", ["player_name"], fields=["season", "pts"])) == \
        rows(full, ["player_name", "season", "pts"])


def scans(p: str, column: str) -> int:
    """File scans that read ``column`` (reused exchanges are listed once)."""
    return len(re.findall(rf"FileScan parquet \[[^\]]*{column}#", p))


def test_steps_read_each_input_once(spark, sf_dir):
    for q in (c.q_cumulate_dim_step, c.q_scd2_increment, c.q_scd2_increment_null_ends):
        p = plan(q(spark, sf_dir))
        assert scans(p, "o_orderkey") + scans(p, "o_custkey") <= 3, p
    assert scans(plan(k.q_full_outer_one_key(spark, sf_dir)), "o_custkey") <= 2


def test_type_two_loads_collect_no_payload(spark, sf_dir):
    for q in (c.q_scd2_backfill, c.q_scd2_actors_backfill, c.q_scd2_actors_backfill_compat, c.q_quality_class):
        p = plan(q(spark, sf_dir))
        collected = " ".join(re.findall(r"collect_list\([^\n]*?\)", p))
        for unused in ("film#", "votes#", "film_id", "college", "height", "draft_year", "reb#", "gp#"):
            assert unused not in collected, (q.__name__, unused)
    assert "collect_list" not in plan(c.q_quality_class(spark, sf_dir))


def test_small_measured_side_is_broadcast_at_run_time(spark, sf_dir):
    big = spark.range(200_000).select((F.col("id") % 1000).alias("k"), "id")
    small = spark.range(1000).groupBy((F.col("id") % 500).alias("k")).agg(F.count("*").alias("n"))
    joined = big.join(small, "k")
    assert "SortMergeJoin" in plan(joined)
    joined.write.format("noop").mode("overwrite").save()
    ran = joined._jdf.queryExecution()
    joined.collect()
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString() or "BroadcastHashJoin" in ran.executedPlan().toString()


def test_grouped_join_deals_its_rows_over_tasks(spark):
    """Rows of both sides per task stay below the bound; small tables are left to the planner."""
    from dimforge.operators.facts import duplicate_counts
    from dimforge.operators.joins import dealt_join
    left = spark.range(6000).selectExpr("nullif(id % 2000, 7) AS k", "id % 2 AS v").checkpoint()
    right = spark.range(2000).selectExpr("id AS j", "id * 3 AS w").union(spark.createDataFrame([(5, 1), (None, 2)], "j long, w long")).checkpoint()
    want = left.join(right, left.k == right.j)
    few = dealt_join(left, right, "k", "j", task_rows=100)               # 81 tasks
    per_task = [r.n for r in few.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(per_task) > 60 and max(per_task) < 400
    assert few.columns == want.columns and rows(few) == rows(want)
    p = plan(duplicate_counts(few, ["k", "v"]))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 2        # grouped in the tasks of the join
    assert plan(dealt_join(left, right, "k", "j")).count("REPARTITION_BY_NUM") == 0
