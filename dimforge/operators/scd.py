"""Slowly changing dimensions.

Type 2 (one row per run of constant state with start / end period):

* ``scd2_backfill`` — full load from a cumulated table (one row per entity per
  period): change flag against the previous period, running sum = run id,
  one row per run.  Both windows and the final grouping share one hash
  partitioning on the entity key, so the whole job has a single exchange.
* ``scd2_increment`` — load of period t on top of snapshot t-1: only rows
  that are still open can be extended or closed, so only they take part in
  the full outer join with period t; all other history bypasses the shuffle
  and is re-attached with ``unionByName``.
* ``scd2_splice`` — late or corrected periods, in any order of arrival: only
  the runs they fall into or touch are cut and joined again.
* ``scd2_from_spine`` — SCD2 from raw rows over a period spine
  (activity = entity seen in that period).
* ``scd2_from_gaps`` — the same table from the gaps between an entity's
  periods: its work grows with the rows, not with entities × periods.

``compat=True`` reproduces the scripts' three-valued change test (a NULL
state is neither changed nor unchanged: carried without extending its end)
and their choice of change columns; the default compares all tracked
columns null-safely.

Types 0 / 1 / 3: ``scd0``, ``scd1``, ``scd3`` (first / latest / both).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimforge.operators.joins import broadcast_if_small, full_outer
from dimforge.operators.streaks import run_ends, run_starts


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)


def change_flags(keys: Sequence[str], order: str, state_cols: Sequence[str]) -> Column:
    """1 when any tracked column differs (null-safe) from the previous row of
    the entity, or on its first row; else 0."""
    w = Window.partitionBy(*keys).orderBy(order)
    changed = _any([~F.lag(F.col(s), 1).over(w).eqNullSafe(F.col(s)) for s in state_cols])
    first = F.lag(F.lit(1), 1).over(w).isNull()
    return F.when(first | changed, F.lit(1)).otherwise(F.lit(0))


def runs(df: DataFrame, *, keys: Sequence[str], order: str, state_cols: Sequence[str],
         run_col: str = "_run") -> DataFrame:
    """Gaps-and-islands: number the runs of constant ``state_cols`` per entity.

    Both windows use the same partitioning and ordering: one exchange."""
    w = Window.partitionBy(*keys).orderBy(order)
    return (df.withColumn("_chg", change_flags(keys, order, state_cols))
              .withColumn(run_col, F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0)))
              .drop("_chg"))


def scd2_backfill(hist: DataFrame, *, keys: Sequence[str], state_cols: Sequence[str], period: str,
                  as_of: int, start_col: str = "start_season", end_col: str = "end_season",
                  snapshot_col: str = "current_season", carry: Sequence[str] = (),
                  open_end: str = "period") -> DataFrame:
    """Type-2 rows from a table with one row per (entity, period) up to ``as_of``.

    ``carry``: columns constant per entity that are kept (e.g. a name when
    keyed by id).  ``open_end='null'`` stores NULL as the end of runs still
    open at ``as_of`` (the textbook form); the default stores the period,
    as the load scripts do.  Output: keys, carry, state_cols, start, end,
    snapshot.
    """
    h = hist.where(F.col(period) <= as_of).select(*keys, *carry, *state_cols, period)
    r = runs(h, keys=keys, order=period, state_cols=state_cols)
    aggs = [F.max(c).alias(c) for c in carry]
    aggs += [F.max(s).alias(s) for s in state_cols]   # constant (null-safe) within a run
    aggs += [F.min(period).cast("int").alias(start_col), F.max(period).cast("int").alias(end_col)]
    out = r.groupBy(*keys, "_run").agg(*aggs)
    if open_end == "null":
        out = out.withColumn(end_col, F.when(F.col(end_col) < as_of, F.col(end_col)).cast("int"))
    elif open_end != "period":
        raise ValueError("open_end must be 'period' or 'null'")
    return out.select(*keys, *carry, *state_cols, start_col, end_col, F.lit(as_of).cast("int").alias(snapshot_col))


def scd2_backfill_as_written(hist: DataFrame, *, lag_key: str, sum_key: str, group_extra: Sequence[str],
                             state: str, period: str, as_of: int, out_key: str,
                             start_col: str, end_col: str, snapshot_col: str) -> DataFrame:
    """The script's two-attribute full load, kept for comparison: LAG per
    ``lag_key``, running SUM per ``sum_key``, change flag on ``state`` only,
    ``group_extra`` in the GROUP BY (which yields overlapping intervals when
    that column changes inside a run)."""
    h = hist.where(F.col(period) <= as_of)
    w_lag = Window.partitionBy(lag_key).orderBy(period)
    w_sum = Window.partitionBy(sum_key).orderBy(period)     # default RANGE frame, as written
    h = (h.withColumn("_a", F.when(F.col(state), 1).otherwise(0))
          .withColumn("_l", F.when(F.lag(state, 1).over(w_lag), 1).otherwise(0)))
    h = h.withColumn("_streak", F.sum(F.when(F.col("_a") != F.col("_l"), 1).otherwise(0)).over(w_sum))
    return (h.groupBy(out_key, *group_extra, "_streak")
             .agg((F.max("_a") == 1).alias(state), F.min(period).cast("int").alias(start_col),
                  F.max(period).cast("int").alias(end_col))
             .select(out_key, *group_extra, state, start_col, end_col, F.lit(as_of).cast("int").alias(snapshot_col)))


def scd2_increment(prev_scd: DataFrame, cur: DataFrame, *, keys: Sequence[str], state_cols: Sequence[str],
                   t: int, period: str, start_col: str = "start_season", end_col: str = "end_season",
                   snapshot_col: str = "current_season", change_cols: Sequence[str] | None = None,
                   carried: Sequence[str] = (), compat: bool = False, open_end: str = "period",
                   keys_not_null: bool = False) -> DataFrame:
    """Snapshot ``t`` of a type-2 table from snapshot ``t-1`` and period ``t``.

    ``prev_scd``: rows of snapshot t-1 (keys, carried, state_cols, start, end).
    ``cur``: rows of the cumulated table at period ``t``.
    ``change_cols``: columns that decide a change (default: all state_cols).
    ``carried``: columns taken as ``COALESCE(old, new)`` and not compared.
    ``open_end``: how open runs are stored, ``'period'`` (end = snapshot) or
    ``'null'`` (end is NULL), as in :func:`scd2_backfill`.

    A run is open if its end is t-1 or NULL (with ``'null'``: only NULL); all
    other rows, with a later end too, are carried as they are.  An open run
    that meets period ``t`` goes on if nothing changed, else it ends at t-1 and
    a new run starts at t.  ``compat`` applies the scripts' three-valued test:
    a NULL comparison is neither a change nor none, so the run stays as it is
    and a NULL state is filled from the new row.

    Each stored version is one candidate row, the new version another; which
    of the two are written is decided by flags.  ``prev`` should be a stored
    partition or a ``checkpoint()``, sorted by end: open and other runs are
    two filtered reads of it, and only open runs are shuffled.
    """
    if open_end not in ("period", "null"):
        raise ValueError("open_end must be 'period' or 'null'")
    change_cols = list(change_cols or state_cols)
    prev_scd = prev_scd.select(*keys, *carried, *state_cols, start_col, end_col)
    is_open = F.col(end_col).isNull()
    if open_end == "period":
        is_open = is_open | (F.col(end_col) == t - 1)
    open_rows = prev_scd.where(is_open).withColumn("_in_p", F.lit(True))
    others = prev_scd.where(~F.coalesce(is_open, F.lit(False)))
    cur_t = cur.where(F.col(period) == t).select(*keys, *carried, *state_cols).withColumn("_in_c", F.lit(True))
    now = F.lit(t).cast("int")
    still = now if open_end == "period" else F.lit(None).cast("int")

    def project(p, c):
        old, new = p("_in_p").isNotNull(), c("_in_c").isNotNull()
        if compat:
            same = reduce(lambda a, b: a & b, [p(s) == c(s) for s in change_cols])      # NULL: undecided
        else:
            same = reduce(lambda a, b: a & b, [p(s).eqNullSafe(c(s)) for s in change_cols])
        goes_on = F.coalesce(old & new & same, F.lit(False))
        changed = F.coalesce(old & new & ~same, F.lit(False))
        undecided = old & new & ~goes_on & ~changed
        end = F.when(goes_on, still).when(changed, F.coalesce(p(end_col), F.lit(t - 1))).otherwise(p(end_col))

        def version(keep, state, start, stop):
            return F.struct(keep.alias("_keep"), *[F.coalesce(p(x), c(x)).alias(x) for x in carried],
                            *[state(s).alias(s) for s in state_cols],
                            start.cast("int").alias(start_col), stop.cast("int").alias(end_col))

        stored = version(old, lambda s: F.when(undecided, F.coalesce(p(s), c(s))).otherwise(p(s)), p(start_col), end)
        opened = version(new & (~old | changed), c, now, still)
        return [*[F.coalesce(p(k), c(k)).alias(k) for k in keys],
                F.inline(F.filter(F.array(stored, opened), lambda v: v["_keep"]))]

    out = full_outer(open_rows, cur_t, keys, project, keys_not_null=keys_not_null)
    out = out.select(*keys, *carried, *state_cols, start_col, end_col)
    return out.unionByName(others).withColumn(snapshot_col, now)


def scd2_splice(prev_scd: DataFrame | None, late: DataFrame, *, keys: Sequence[str], state_cols: Sequence[str],
                period: str, start_col: str = "start_season", end_col: str = "end_season") -> DataFrame:
    """A type-2 table after periods arrive late or corrected.

    ``prev_scd``: runs (keys, state_cols, start, end), each period of a run
    observed; ``late``: rows (keys, period, state_cols) that add a period or
    replace its state, before, inside or after the stored runs.  Periods are
    integers; a run ends where the next period was not observed or has
    another state.  Whatever the order in which periods arrive, the result is
    that of one load of all of them; where every period of an entity has come
    it equals :func:`scd2_backfill`.

    Only runs that hold a late period, or touch one (end just before it, begin
    just after), are cut and joined again, with the late periods as runs of
    length one; all other rows pass as they are and are not shuffled as long
    as the late periods fit a checked broadcast.

    Defined results: an entity with a NULL key is an entity; a NULL state is a
    state; of several late rows for one period the greatest state counts; an
    empty ``late`` changes nothing.
    """
    span = [start_col, end_col]
    new = (late.where(F.col(period).isNotNull()).groupBy(*keys, F.col(period).cast("int").alias(start_col))
               .agg(F.max(F.struct(*state_cols)).alias("_s"))
               .select(*keys, *[F.col(f"_s.{s}").alias(s) for s in state_cols], start_col, F.col(start_col).alias(end_col)))
    if prev_scd is None:
        return _joined_runs(new, keys, state_cols, start_col, end_col)
    prev_scd = prev_scd.select(*keys, *state_cols, *span)
    points = new.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(start_col).alias("_p"))
    points = broadcast_if_small(points)
    meets = reduce(lambda a, b: a & b, [prev_scd[k].eqNullSafe(points[f"_{k}"]) for k in keys]
                   + [points["_p"].between(prev_scd[start_col] - 1, prev_scd[end_col] + 1)])
    untouched = prev_scd.join(points, meets, "left_anti")
    hit = (prev_scd.join(points, meets).groupBy(*keys, *state_cols, *span)
                   .agg(F.sort_array(F.collect_set(F.when(F.col("_p").between(F.col(start_col), F.col(end_col)), F.col("_p")))).alias("_ps")))
    # what lies between the late periods of a run: from one bound + 1 to the next - 1
    bounds = F.concat(F.array(F.col(start_col) - 1), "_ps", F.array(F.col(end_col) + 1))
    parts = F.transform(F.sequence(F.lit(1), F.size("_ps") + 1),
                        lambda i: F.struct((F.get(bounds, i - 1) + 1).alias(start_col), (F.get(bounds, i) - 1).alias(end_col)))
    kept = hit.select(*keys, *state_cols, F.inline(F.filter(parts, lambda r: r[start_col] <= r[end_col])))
    return untouched.unionByName(_joined_runs(kept.unionByName(new), keys, state_cols, start_col, end_col))


def _joined_runs(pieces: DataFrame, keys, state_cols, start_col, end_col) -> DataFrame:
    """Disjoint runs, neighbours of equal state joined."""
    w = Window.partitionBy(*keys).orderBy(start_col)
    same = reduce(lambda a, b: a & b, [F.lag(F.col(s)).over(w).eqNullSafe(F.col(s)) for s in state_cols])
    goes_on = F.coalesce((F.lag(end_col).over(w) == F.col(start_col) - 1) & same, F.lit(False))
    numbered = (pieces.withColumn("_new", (~goes_on).cast("int"))
                      .withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return (numbered.groupBy(*keys, *state_cols, "_run")
                    .agg(F.min(start_col).cast("int").alias(start_col), F.max(end_col).cast("int").alias(end_col))
                    .select(*keys, *state_cols, start_col, end_col))


def scd2_from_spine(raw: DataFrame, *, keys: Sequence[str], period: str, lo: int, hi: int,
                    current_period: int | None = None, active_col: str = "is_active",
                    start_col: str = "start_season", end_col: str = "end_season",
                    current_col: str = "is_current") -> DataFrame:
    """Type 2 over a period spine from raw rows: active = entity has a row in
    that period.  Every entity gets all periods ``lo..hi`` (inactive runs
    included).  ``is_current`` = run ends at ``current_period`` (default hi).

    One exchange: the per-entity set of periods (partially aggregated before
    the shuffle) is expanded inside the task; the windows and the run
    grouping reuse the entity partitioning.
    """
    cur = hi if current_period is None else current_period
    sets = raw.groupBy(*keys).agg(
        F.collect_set(F.when(F.col(period).between(lo, hi), F.col(period))).alias("_ps"))
    grid = sets.select(*keys, "_ps", F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("_p"))
    grid = grid.select(*keys, "_p", F.array_contains("_ps", F.col("_p")).alias(active_col))
    r = runs(grid, keys=keys, order="_p", state_cols=[active_col])
    return (r.groupBy(*keys, active_col, "_run")
             .agg(F.min("_p").cast("int").alias(start_col), F.max("_p").cast("int").alias(end_col))
             .select(*keys, active_col, start_col, end_col, (F.col(end_col) == cur).alias(current_col)))


def scd2_from_gaps(raw: DataFrame, *, keys: Sequence[str], period: str, lo: int, hi: int,
                   current_period: int | None = None, active_col: str = "is_active",
                   start_col: str = "start_season", end_col: str = "end_season",
                   current_col: str = "is_current") -> DataFrame:
    """:func:`scd2_from_spine` without the spine: active runs are the stretches
    of an entity's sorted periods, inactive runs what lies between them and the
    bounds.  An entity with k periods costs k steps however long the spine is.

    Defined results: periods outside ``lo..hi`` and NULL do not count, an entity
    with no other has one inactive run; repeated rows count once; a NULL key is
    an entity.  One exchange (sets are partial before it), no window."""
    cur = hi if current_period is None else current_period
    p = F.col(period).cast("int")
    sets = raw.groupBy(*keys).agg(F.sort_array(F.collect_set(F.when(p.between(lo, hi), p))).alias("_ps"))
    edges = sets.select(*keys, run_starts("_ps").alias("_s"), run_ends("_ps").alias("_e"))

    def rows(starts, ends, active):
        return F.zip_with(starts, ends, lambda s, e: F.struct(F.lit(active).alias(active_col), s.alias(start_col), e.alias(end_col)))

    after = F.concat(F.array(F.lit(lo).cast("int")), F.transform("_e", lambda e: e + 1))
    before = F.concat(F.transform("_s", lambda s: s - 1), F.array(F.lit(hi).cast("int")))
    gaps = F.filter(rows(after, before, False), lambda r: r[start_col] <= r[end_col])
    return (edges.select(*keys, F.inline(F.concat(rows("_s", "_e", True), gaps)))
                 .withColumn(current_col, F.col(end_col) == cur))


# --- types 0, 1, 3 ---------------------------------------------------------

def scd0(hist: DataFrame, *, keys: Sequence[str], col: str, period: str) -> DataFrame:
    """Type 0: the value as first recorded (never changes)."""
    return hist.groupBy(*keys).agg(F.min_by(col, period).alias(col))


def scd1(hist: DataFrame, *, keys: Sequence[str], col: str, period: str) -> DataFrame:
    """Type 1: only the latest value."""
    return hist.groupBy(*keys).agg(F.max_by(col, period).alias(col), F.max(period).alias(f"{period}_latest"))


def scd3(hist: DataFrame, *, keys: Sequence[str], col: str, period: str) -> DataFrame:
    """Type 3: original and current value (one aggregation, partial before the shuffle)."""
    return hist.groupBy(*keys).agg(
        F.min_by(col, period).alias(f"original_{col}"), F.min(period).alias(f"original_{period}"),
        F.max_by(col, period).alias(f"current_{col}"), F.max(period).alias(f"current_{period}"))
