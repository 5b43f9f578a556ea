"""Late and corrected periods, jobs run again, the load ledger, ties and
histories in segments."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from dimforge import jobs
from dimforge.operators import datelist as dl
from dimforge.operators import facts as fa
from dimforge.operators import scd
from dimforge.operators.segments import append_segments, fold_segments, segments
from dimforge.operators.windows import running_total_of_ties
from dimforge.sinks import ledger
from dimforge.sinks.publish import MissingPartition, publish, read_partition
from dimforge.sources import fixtures as fx

# --- SCD2 splice -----------------------------------------------------------------

STATE = "who string, p int, state string, flag boolean"
SPLICE = dict(keys=["who"], state_cols=["state", "flag"], period="p", start_col="s", end_col="e")


def plain_runs(seen):
    """Runs of (who -> period -> state), broken where a period is missing."""
    out = []
    for who, by in seen.items():
        for p in sorted(by):
            if out and out[-1][0] == who and out[-1][4] == p - 1 and out[-1][1:3] == by[p]:
                out[-1] = (*out[-1][:4], p)
            else:
                out.append((who, *by[p], p, p))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_arrival_gives_the_full_load(spark, seed):
    rng = random.Random(seed)
    names = ["a", "b", None]
    made = [(w, p, rng.choice(["x", "x", "y", None]), rng.random() < 0.8) for w in names for p in range(1, 9)]
    first = [(w, p, rng.choice(["x", "y"]), True) for w, p, _, _ in made]           # corrected later
    arrivals = first + made
    rng.shuffle(arrivals)
    arrivals += [r for r in made]
    table, seen = None, {}
    for i in range(0, len(arrivals), 16):
        batch = {r[:2]: r for r in arrivals[i:i + 16]}.values()                     # one row per period
        for w, p, s, f in batch:
            seen.setdefault(w, {})[p] = (s, f)
        table = scd.scd2_splice(table, spark.createDataFrame(list(batch), STATE), **SPLICE).checkpoint()
        assert sorted(map(tuple, table.collect()), key=repr) == plain_runs(seen)
    full = scd.scd2_backfill(spark.createDataFrame(made, STATE), keys=["who"], state_cols=["state", "flag"], period="p",
                             as_of=8, start_col="s", end_col="e")
    assert rows(table, ["who", "state", "flag", "s", "e"]) == rows(full, ["who", "state", "flag", "s", "e"])


def test_splice_of_nothing_and_of_repeated_rows(spark):
    table = scd.scd2_splice(None, spark.createDataFrame([("a", 3, "x", True), ("a", 3, "x", True), ("a", None, "x", True)], STATE), **SPLICE)
    assert [tuple(r) for r in table.collect()] == [("a", "x", True, 3, 3)]
    same = scd.scd2_splice(table, spark.createDataFrame([], STATE), **SPLICE)
    assert [tuple(r) for r in same.collect()] == [("a", "x", True, 3, 3)]


def test_untouched_runs_are_not_shuffled(spark):
    table = spark.range(1000).selectExpr("cast(id as string) who", "'x' state", "true flag", "1 s", "9 e").checkpoint()
    late = spark.createDataFrame([("7", 5, "y", True)], STATE)
    got = scd.scd2_splice(table, late, **SPLICE)
    plan = got._jdf.queryExecution().toString()
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan
    assert got.count() == 1002


# --- bit history ---------------------------------------------------------------------

def test_forty_steps_equal_the_direct_bits(spark):
    rng = random.Random(1)
    day0 = dt.datetime(2024, 1, 1)
    events = [(rng.choice([1, 2, 3, 4, None]), day0 + dt.timedelta(days=rng.randrange(40), hours=rng.randrange(24))) for _ in range(90)]
    events += [(5, day0), (6, day0 + dt.timedelta(days=3))]                          # leave the window
    ev = spark.createDataFrame(events, "user_id long, event_time timestamp").checkpoint()
    state = None
    for i in range(40):
        day = (day0 + dt.timedelta(days=i)).date()
        state = dl.bits_step(state, ev, ts_col="event_time", day=day.isoformat()).checkpoint()
        if i in (0, 17, 39):
            lo = max(day0.date(), day - dt.timedelta(days=30))
            want = dl.bits_direct(ev, ts_col="event_time", lo=lo.isoformat(), hi=day.isoformat())
            assert rows(state, ["user_id", "history_int"]) == rows(want, ["user_id", "history_int"])
    last = day0 + dt.timedelta(days=40)
    for r in state.withColumn("w", dl.recent_days(F.col("history_int"), 7)).collect():
        assert r["w"] == len({t.date() for u, t in events if u == r["user_id"] and last - dt.timedelta(days=7) <= t})
    with pytest.raises(ValueError):
        dl.recent_days(F.col("history_int"), 32)


# --- jobs run again --------------------------------------------------------------------

def test_a_month_survives_reloads_in_any_order(spark, sf_dir, tmp_path):
    events = str(tmp_path / "web_events")
    fx.web_events(spark, sf_dir).write.parquet(events)
    daily_t, monthly_t = str(tmp_path / "daily"), str(tmp_path / "monthly")
    jobs.daily_metric(spark, events, daily_t)
    days = [f"2024-01-0{i}" for i in range(1, 5)]
    for d in [*days, days[0], days[2]]:
        jobs.monthly_array(spark, daily_t, monthly_t, d, days[0])
    want = fa.monthly_array_backfill(spark.read.parquet(daily_t), month_start=days[0], through=days[-1])
    cols = ["user_id", "metric_name", "metric_array"]
    assert rows(spark.read.parquet(monthly_t), cols) == rows(want, cols)


def test_an_empty_day_replaces_the_loaded_one(spark, sf_dir, tmp_path):
    events, none, table = (str(tmp_path / n) for n in ("events", "none", "daily"))
    ev = fx.web_events(spark, sf_dir)
    ev.write.parquet(events)
    ev.where("false").write.parquet(none)
    for d in ("2024-01-02", "2024-01-03", "2024-01-02"):
        jobs.daily_metric(spark, events, table, d)
    both = spark.read.parquet(table).count()
    jobs.daily_metric(spark, none, table, "2024-01-02")
    left = spark.read.parquet(table)
    assert 0 < left.count() < both and {str(r["date"]) for r in left.collect()} == {"2024-01-03"}


def test_rows_of_another_partition_raise(spark, tmp_path):
    df = spark.createDataFrame([(1, 2000, None), (2, 2001, "x")], "id long, season int, t string")
    with pytest.raises(Exception, match="outside the partition"):
        publish(df, str(tmp_path / "t"), ["season"], partition={"season": 2000})
    publish(df.where("season = 2000"), str(tmp_path / "u"), ["season"], partition={"season": 2000})
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "u")).select("id", "season", "t").collect()] == [(1, 2000, None)]


def test_dedupe_in_place_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError):
        jobs.dedupe(spark, path + "/", path, ["id"], ["id"])
    assert spark.read.parquet(path).count() == 3


# --- ledger --------------------------------------------------------------------------------

def test_a_load_that_stops_before_the_ledger_does_not_count(spark, tmp_path, monkeypatch):
    path, log = str(tmp_path / "t"), str(tmp_path / "ledger")
    df = spark.createDataFrame([(i, 2000 + i % 3) for i in range(9)], "id long, season int")
    part = lambda t: df.where(F.col("season") == t)
    spine = spark.createDataFrame([(2000,), (2001,), (2002,)], "season int")
    assert ledger.missing(spark, log, "t", spine, "season").count() == 3
    ledger.load(part(2000), log, "t", path, "season", 2000, input_version="v1")

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ledger, "record", crash)
    with pytest.raises(RuntimeError):
        ledger.load(part(2001), log, "t", path, "season", 2001, after=2000)
    monkeypatch.undo()
    assert read_partition(spark, path, "season", 2001).count() == 3                  # the data is there
    assert not ledger.is_loaded(spark, log, "t", 2001)
    with pytest.raises(MissingPartition):
        ledger.load(part(2002), log, "t", path, "season", 2002, after=2001)
    ledger.load(part(2001), log, "t", path, "season", 2001, input_version="v1", after=2000)
    ledger.load(part(2002).where("false"), log, "t", path, "season", 2002, input_version="v1", after=2001)
    assert rows(ledger.loaded(spark, log, "t")) == [("2000", 3, "v1"), ("2001", 3, "v1"), ("2002", 0, "v1")]
    assert ledger.missing(spark, log, "t", spine, "season").count() == 0
    now = spark.createDataFrame([(2000, "v2"), (2001, "v1"), (2003, "v1")], "season int, input_version string")
    assert sorted(r["season"] for r in ledger.outdated(spark, log, "t", now, "season").collect()) == [2000, 2003]
    ledger.load(part(2000).limit(1), log, "t", path, "season", 2000, input_version="v2")
    assert ("2000", 1, "v2") in rows(ledger.loaded(spark, log, "t"))


# --- ties ------------------------------------------------------------------------------------

def test_rows_of_one_order_value_are_spread(spark):
    hot = spark.range(400_000).selectExpr("'k' as k", "1 as o", "id % 7 as v", "id")
    rest = spark.createDataFrame([("k", 0, 5, -1), ("k", 2, None, -2), ("k", None, 3, -3), (None, 1, 2, -4), (None, 1, None, -5),
                                  ("z", 1, None, -6)], "k string, o int, v long, id long")
    df = hot.unionByName(rest)
    got = running_total_of_ties(df, key="k", order="o", value="v", out="t", hot_rows=1000)
    want = df.withColumn("t", F.sum("v").over(Window.partitionBy("k").orderBy("o")))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    parts = got.where("o = 1 and k = 'k'").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 200_000
    assert running_total_of_ties(df.where("false"), key="k", order="o", value="v", out="t").count() == 0


# --- segments -----------------------------------------------------------------------------------

def test_segments_are_the_plain_list(spark):
    rng = random.Random(2)
    data = [(rng.choice(["hot", "hot", "hot", "b", None]), rng.randrange(50), i) for i in range(600)]
    df = spark.createDataFrame(data, "who string, t int, id long")
    kw = dict(keys=["who"], order=["t", "id"], item_cols=["id", "t"], size=16, hot_rows=100, chunks=5)
    stored = segments(df, **kw).checkpoint()
    plain = {w: [(i, t) for _, t, i in sorted((r for r in data if r[0] == w), key=lambda r: r[1:])] for w in ("hot", "b", None)}

    def joined(found):
        out = {}
        for r in sorted(found, key=lambda r: r["segment"]):
            assert len(out.setdefault(r["who"], [])) == 16 * r["segment"] and len(r["items"]) <= 16
            out[r["who"]] += [tuple(x) for x in r["items"]]
        return out

    assert joined(stored.collect()) == plain
    more = [(w, 90, 1000 + i) for i, w in enumerate(["hot", "new", None] * 20)]
    changed = append_segments(stored, spark.createDataFrame(more, df.schema), **kw).collect()
    whole = {(r["who"], r["segment"]): r for r in stored.collect()}
    assert all((r["who"], r["segment"]) not in whole or len(whole[r["who"], r["segment"]]["items"]) < 16 for r in changed)
    whole.update({(r["who"], r["segment"]): r for r in changed})
    for w, t, i in more:
        plain.setdefault(w, []).append((i, t))
    assert joined(whole.values()) == plain
    folded = fold_segments(stored, keys=["who"], per_segment={"n": F.size("items")}, across={"n": F.sum("n")})
    assert {r["who"]: r["n"] for r in folded.collect()} == {w: sum(r[0] == w for r in data) for w in ("hot", "b", None)}
    assert segments(df.where("false"), **kw).count() == 0
