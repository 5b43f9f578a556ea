"""Randomised properties (hypothesis) on small literal histories."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from dimforge.operators import datelist as dl
from dimforge.operators import scd

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))

# (entity, period, state): each entity has a contiguous run of periods with
# a nullable categorical state.
histories = st.lists(
    st.tuples(st.sampled_from("abcd"), st.integers(0, 3), st.integers(1, 6),
              st.lists(st.sampled_from(["x", "y", None]), min_size=6, max_size=6)),
    min_size=1, max_size=4, unique_by=lambda t: t[0])


def _hist_rows(h):
    out = []
    for k, start, n, states in h:
        for i in range(n):
            out.append((k, 2000 + start + i, states[i]))
    return out


@SETTINGS
@given(histories)
def test_scd2_intervals_tile_the_history(spark, h):
    df = spark.createDataFrame(_hist_rows(h), "k string, p int, s string")
    as_of = max(r[1] for r in _hist_rows(h))
    out = scd.scd2_backfill(df, keys=["k"], state_cols=["s"], period="p", as_of=as_of,
                            start_col="b", end_col="e", snapshot_col="snap")
    exploded = out.select("k", F.explode(F.sequence("b", "e")).alias("p"), "s")
    assert rows(exploded, ["k", "p", "s"]) == rows(df, ["k", "p", "s"])
    # adjacent runs of an entity always differ (null-safe), so runs are maximal
    runs = sorted(out.select("k", "b", "s").collect(), key=lambda r: (r.k, r.b))
    for a, b in zip(runs, runs[1:]):
        if a.k == b.k:
            assert a.s != b.s


@SETTINGS
@given(histories)
def test_scd2_increment_chain_equals_full_load(spark, h):
    df = spark.createDataFrame(_hist_rows(h), "k string, p int, s string")
    lo = min(r[1] for r in _hist_rows(h))
    hi = max(r[1] for r in _hist_rows(h))
    kw = dict(keys=["k"], state_cols=["s"], period="p", start_col="b", end_col="e", snapshot_col="snap")
    snap = scd.scd2_backfill(df, as_of=lo, **kw)
    for t in range(lo + 1, hi + 1):
        # each step reads the previous snapshot three times: cut the lineage
        # (as a stored partition would) so the plan does not grow 3^steps
        snap = scd.scd2_increment(snap, df, t=t, **kw).checkpoint()
    full = scd.scd2_backfill(df, as_of=hi, **kw)
    assert rows(snap, full.columns) == rows(full)


events = st.lists(st.tuples(st.sampled_from([1, 2, 3, None]), st.integers(0, 6)), min_size=1, max_size=25)


@SETTINGS
@given(events)
def test_datelist_step_chain_equals_backfill(spark, ev):
    base = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(u, base + dt.timedelta(days=d)) for u, d in ev], "user_id bigint, ts timestamp_ntz")
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i)).isoformat() for i in range(7)]
    prev = None
    for d in days:
        prev = dl.datelist_step(prev, df, keys=["user_id"], ts_col="ts", day=d).checkpoint()
    closed = dl.datelist_backfill(df, keys=["user_id"], ts_col="ts", lo=days[0], hi=days[-1])
    assert rows(prev) == rows(closed.select(*prev.columns))
    bits = dl.bits_direct(df, ts_col="ts", lo=days[0], hi=days[-1])
    via_list = dl.datelist_bits(closed, lo=days[0], hi=days[-1])
    assert rows(bits) == rows(via_list.select(*bits.columns))
