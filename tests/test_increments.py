"""Streak states, runs from gaps, upserts, partition statistics, checked casts,
frequent keys, loads against stored facts."""

import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from dimforge.functions.scalars import to_type
from dimforge.operators import facts as fa
from dimforge.operators import scd
from dimforge.operators.joins import frequent_keys, split_join
from dimforge.operators.streaks import merge_streaks, streak_states, streak_step
from dimforge.sinks.append import append_new, new_rows, stored_keys
from dimforge.sinks.publish import publish
from dimforge.sinks.statistics import merged_statistics, partition_statistics
from dimforge.sinks.upsert import apply_changes


def plain_state(periods):
    ps = sorted(set(periods))
    runs = []
    for p in ps:
        if runs and runs[-1][1] == p - 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    top = max(runs, key=lambda r: (r[1] - r[0], -r[0]))
    return (ps[0], ps[-1], runs[0][1] - runs[0][0] + 1, runs[-1][1] - runs[-1][0] + 1, top[1] - top[0] + 1, top[0])


def hits_of(spark, made):
    return spark.createDataFrame(made, "who string, p int")


# --- streaks -----------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(3))
def test_streak_chunks_equal_one_pass(spark, seed):
    rng = random.Random(seed)
    made = [(w, p) for w in ["a", "b", None] for p in range(-40, 60) if rng.random() < 0.8] + [("full", p) for p in range(50)]
    made += rng.sample(made, 30) + [("a", None), ("none", None)]
    want = sorted(((w, *plain_state([p for v, p in made if v == w and p is not None])) for w in {w for w, _ in made} - {"none"}), key=repr)
    for chunk in (1, 7, 1000):
        got = merge_streaks(streak_states(hits_of(spark, made), keys=["who"], period="p", chunk=chunk), keys=["who"])
        assert rows(got) == want


def test_streak_steps_equal_all_periods_so_far(spark):
    rng = random.Random(5)
    made = [(w, p) for w in ["a", None] for p in range(12) if rng.random() < 0.7]
    state = None
    for t in range(0, 12, 3):
        state = streak_step(state, hits_of(spark, [r for r in made if t <= r[1] < t + 3]), keys=["who"], period="p").checkpoint()
        seen = {w: [p for v, p in made if v == w and p < t + 3] for w in ["a", None]}
        assert rows(state) == sorted(((w, *plain_state(ps)) for w, ps in seen.items() if ps), key=repr)
    assert rows(streak_step(state, hits_of(spark, []), keys=["who"], period="p")) == rows(state)
    with pytest.raises(PySparkException, match="overlap"):
        streak_step(state, hits_of(spark, [("a", 3)]), keys=["who"], period="p").collect()


# --- runs from gaps ------------------------------------------------------------------

def test_gap_runs_equal_the_spine(spark):
    rng = random.Random(2)
    made = [(w, p) for w in ["a", "b", None] for p in range(1, 15) if rng.random() < 0.6]
    made += made[:9] + [("out", 99), ("null", None), ("lo", 1), ("hi", 14), ("all", 1)] + [("all", p) for p in range(2, 15)]
    kw = dict(keys=["who"], period="p", lo=1, hi=14, current_period=14)
    assert rows(scd.scd2_from_gaps(hits_of(spark, made), **kw)) == rows(scd.scd2_from_spine(hits_of(spark, made), **kw))
    assert scd.scd2_from_gaps(hits_of(spark, []), **kw).count() == 0


def test_gap_runs_on_a_long_spine_need_no_grid(spark):
    raw = spark.range(5000).select((F.col("id") % 100).alias("who"), (F.col("id") * 7919 % 10_000).cast("int").alias("p"))
    kw = dict(keys=["who"], period="p", lo=0, hi=9999)
    found = scd.scd2_from_gaps(raw, **kw)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan
    assert rows(found) == rows(scd.scd2_from_spine(raw, **kw))


# --- upserts -------------------------------------------------------------------------

TABLE = "k string, v int, day int"


def files(path):
    return {f"{os.path.basename(d)}/{f}" for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_upsert_equals_a_rebuild_and_leaves_other_files(spark, tmp_path):
    path = str(tmp_path / "t")
    table = [(f"k{i}", i, i % 4) for i in range(40)] + [(None, -1, 2)]
    publish(spark.createDataFrame(table, TABLE), path, ["day"])
    before = files(path)
    changes = spark.createDataFrame([
        ("k0", 100, 0, False, 1), ("k4", 0, 0, True, 1),                      # corrected, deleted
        ("k8", 8, 2, None, 1), ("new", 1, 7, False, 1),                       # moved, added in a new partition
        ("k12", 1, 0, False, 1), ("k12", 2, 0, False, 2), ("k12", 2, 0, False, 2),        # the later word; repeated
        (None, 5, 2, False, 1), ("unknown", 0, 3, True, 1)], TABLE + ", deleted boolean, said int")
    want = {k: (k, v, d) for k, v, d in table}
    want.update({"k0": ("k0", 100, 0), "k8": ("k8", 8, 2), "new": ("new", 1, 7), "k12": ("k12", 2, 0), None: (None, 5, 2)})
    del want["k4"]
    for _ in range(2):
        touched = apply_changes(changes, path, keys=["k"], partition="day", order=["said"])
        assert rows(spark.read.schema(TABLE).parquet(path)) == sorted(want.values(), key=repr)
    assert touched == [0, 2, 7]                                               # k8 lies in day 2 by now
    assert {f for f in before if f.startswith(("day=1/", "day=3/"))} <= files(path)
    assert not {f for f in before if f.startswith(("day=0/", "day=2/"))} & files(path)


def test_upsert_may_empty_a_partition_and_start_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_in = spark.createDataFrame([("a", 1, 1), ("b", 2, 2), ("c", 3, None)], TABLE)
    assert apply_changes(rows_in.withColumn("deleted", F.lit(False)), path, keys=["k"], partition="day") == [None, 1, 2]
    gone = spark.createDataFrame([("a", 0, 9, True), ("c", 0, None, True)], TABLE + ", deleted boolean")
    assert apply_changes(gone, path, keys=["k"], partition="day") == [None, 1]
    assert rows(spark.read.schema(TABLE).parquet(path)) == [("b", 2, 2)]
    assert apply_changes(gone, path, keys=["k"], partition="day") == []
    assert apply_changes(gone.where("false"), path, keys=["k"], partition="day") == []


# --- statistics ------------------------------------------------------------------------

def test_partition_statistics_merge_for_any_range(spark):
    df = spark.range(60_000).select((F.col("id") % 6).alias("day"), (F.col("id") % 5000).alias("n"),
                                    F.when(F.col("id") % 10 > 0, F.col("id").cast("string")).alias("s"),
                                    F.lit(None).cast("double").alias("nothing"))
    stored = partition_statistics(df, ["day"], ["n", "s", "nothing"]).checkpoint()
    for days in ([0, 1, 2, 3, 4, 5], [2, 3], [4]):
        part = df.where(F.col("day").isin(days))
        got = {r["column_name"]: r for r in merged_statistics(stored.where(F.col("day").isin(days)), ["n", "s", "nothing"], (0.25, 0.5)).collect()}
        n, dn, ds, nulls, lo, hi = part.agg(F.count("*"), F.countDistinct("n"), F.countDistinct("s"), F.count_if(F.col("s").isNull()),
                                            F.min("s"), F.max("s")).first()
        assert got["n"].n_rows == n and got["n"].n_nulls == 0 and got["s"].n_nulls == nulls
        assert (got["s"].min_value, got["s"].max_value) == (lo, hi)
        assert abs(got["n"].n_distinct - dn) <= 0.05 * dn and abs(got["s"].n_distinct - ds) <= 0.05 * ds
        for q, v in zip((0.25, 0.5), got["n"].quantiles):
            assert abs(part.where(F.col("n") <= v).count() / n - q) < 0.02
        assert got["s"].quantiles is None and got["nothing"].quantiles is None
        assert got["nothing"].n_nulls == n and got["nothing"].n_distinct == 0
    none = merged_statistics(stored.where("false"), ["n", "s"]).collect()
    assert [(r.n_rows, r.n_nulls, r.min_value, r.n_distinct) for r in none] == [(0, 0, None, 0)] * 2


# --- casts --------------------------------------------------------------------------------

def test_checked_casts(spark):
    df = spark.createDataFrame([("12",), ("12:30",), ("",), (None,), ("99999999999",)], "s string")
    assert [r[0] for r in df.select(to_type("s", "int")).collect()] == [12, None, None, None, None]
    assert [r[0] for r in df.where("s = '12' OR s IS NULL").select(to_type("s", "int", strict=True)).collect()] == [12, None]
    with pytest.raises(PySparkException, match="not a value of type int: 12:30"):
        df.select(to_type("s", "int", strict=True)).collect()


# --- frequent keys ----------------------------------------------------------------------

def hot_events(spark, n=40_000):
    """Half of the events on device 7, a tenth without a device."""
    i = F.col("id")
    return spark.range(n).select(i, F.when(i % 2 == 0, 7).when(i % 10 == 1, None).otherwise(i % 3000).alias("device"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("max_rows", [100_000, 0])
def test_split_join_equals_the_plain_join(spark, how, max_rows):
    facts = hot_events(spark).checkpoint()
    dim = spark.range(2500).selectExpr("id AS device", "concat('d', id) AS name").union(
        spark.createDataFrame([(7, "again"), (None, "none")], "device long, name string")).checkpoint()
    assert [r[0] for r in frequent_keys(facts, ["device"], 8).collect()] == [facts.where("device = 7").select(F.xxhash64("device")).first()[0]]
    got = split_join(facts, dim, ["device"], how=how, parts=8, max_rows=max_rows)
    want = facts.join(dim, "device", how).select("id", "device", "name")
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_split_join_shuffles_only_rare_keys(spark):
    facts = hot_events(spark).checkpoint()
    dim = spark.range(2500).selectExpr("id AS device", "concat('d', id) AS name").checkpoint()
    tasks = split_join(facts, dim, ["device"], parts=8).where("device = 7 OR device IS NULL").groupBy(F.spark_partition_id(), "device").count()
    spread = tasks.agg(F.max("count"), F.sum("count")).first()
    assert spread[1] == 24_014 and spread[0] <= 5_010       # as in the input; the plain join puts all 20,014 rows of device 7 in one task
    none = facts.where("false")
    assert split_join(none, dim, ["device"], parts=8).count() == 0
    assert split_join(facts, dim.where("false"), ["device"], parts=8).where("name IS NULL").count() == 40_000


# --- loads against stored facts ------------------------------------------------------------

FACT = "k int, part int, v string"


def test_loads_equal_one_dedupe(spark, tmp_path):
    rng = random.Random(3)
    made = [(rng.choice([None, *range(30)]), None, f"{i:03d}") for i in range(200)]
    made = [(k, None if k is None else k % 3, v) for k, _, v in made]
    made += made[:20]
    order = ["v"]
    path = str(tmp_path / "t")
    for i in range(0, 200, 50):
        load = spark.createDataFrame([r for r in made if i <= int(r[2]) < i + 50], FACT)
        for _ in range(2):
            append_new(load, path, keys=["k"], partition="part", order=order)
    append_new(load.where("false"), path, keys=["k"], partition="part", order=order)
    want = fa.dedupe_first(spark.createDataFrame(made, FACT), ["k"], order)
    assert rows(spark.read.schema(FACT).parquet(path), ["k", "part", "v"]) == rows(want, ["k", "part", "v"])


def test_loads_read_only_their_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    append_new(spark.range(300).selectExpr("cast(id AS int) k", "cast(id % 3 AS int) part", "'x' v"), path, keys=["k"],
               partition="part", order=["v"])
    load = spark.createDataFrame([(4, 1, "y"), (301, 1, "y")], FACT)
    known = stored_keys(load, path, ["k"], "part")
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "part" in plan.split("PartitionFilters")[1][:60]
    assert "GreaterThanOrEqual(k,4)" in plan and "LessThanOrEqual(k,301)" in plan
    assert {r.part for r in known.collect()} == {1} and min(r.k for r in known.collect()) >= 4
    append_new(load, path, keys=["k"], partition="part", order=["v"])
    assert rows(spark.read.schema(FACT).parquet(path).where("v = 'y'"), ["k", "part", "v"]) == [(301, 1, "y")]


def test_a_load_is_shuffled_once_to_meet_the_stored_keys(spark, tmp_path):
    path, kw = str(tmp_path / "t"), dict(keys=["k"], partition="part", order=["v"])
    load = spark.range(300).selectExpr("nullif(cast(id % 200 AS int), 9) k", "cast(nullif(id % 200, 9) % 3 AS int) part", "concat('v', id) v")
    append_new(load.where("k < 50 OR k IS NULL"), path, **kw)
    got = new_rows(load, path, **kw)
    p = got._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange") == 1 and p.count("WindowGroupLimit") == 2 and "Join" not in p
    want = fa.dedupe_first(load.where("k >= 50"), ["k"], ["v"])
    assert got.columns == load.columns and rows(got) == rows(want)
    append_new(load, path, **kw)
    assert new_rows(load, path, **kw).isEmpty()
    assert rows(spark.read.schema(FACT).parquet(path), ["k", "part", "v"]) == rows(fa.dedupe_first(load, ["k"], ["v"]))
