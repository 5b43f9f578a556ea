"""Cumulative dimensions (one row per entity per period, history in an array).

Two forms of the same table:

* ``cumulate_step`` — the incremental load: snapshot t-1 FULL OUTER JOIN the
  rows of period t on the entity key.  Constant attributes keep the oldest
  non-NULL value, the period's items are prepended (``accumulate``) or
  replace the history (``replace``), ``is_active`` marks presence, the
  snapshot period is ``COALESCE(new period, old snapshot + 1)``.
* ``cumulate_backfill`` — the same table for every period ``lo..hi`` in one
  job: one exchange on the entity key (``collect_list`` of the entity's
  period rows), then every snapshot is derived inside the task with
  higher-order functions.  No driver loop and no lineage that grows with the
  number of periods.

Array sizes are bounded by the periods (and items) of one entity, which is
the data model itself: the full history lives in one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.operators.joins import full_outer


def period_items(raw: DataFrame, *, keys: Sequence[str], period: str, item_cols: Sequence[str],
                 history_col: str, attrs: Sequence[str] = (),
                 period_aggs: Mapping[str, Column] | None = None,
                 unique_per_period: bool | str = False) -> DataFrame:
    """Reduce raw rows to one row per (entity, period).

    ``history_col`` holds the period's items as an array of structs built by
    name from ``item_cols`` (sorted, so the result is deterministic).  With
    ``unique_per_period`` the input already has one row per (entity, period)
    and no aggregation is done (``'check'`` verifies that first and raises
    :class:`DuplicatePeriodRows`).  ``period_aggs`` are extra aggregates of
    the period (e.g. an average rating band).
    """
    item = F.struct(*[F.col(c) for c in item_cols])
    if unique_per_period == "check":
        assert_unique_keys(raw, [*keys, period])
    if unique_per_period:
        extra = [expr.alias(name) for name, expr in (period_aggs or {}).items()]
        return raw.select(*keys, period, *attrs, F.array(item).alias(history_col), *extra)
    aggs = [F.sort_array(F.collect_list(item)).alias(history_col)]
    aggs += [F.min(a).alias(a) for a in attrs]
    aggs += [expr.alias(name) for name, expr in (period_aggs or {}).items()]
    # Items are gathered per task before the exchange on (entity, period): a hot
    # entity, or the NULL one, is dealt out by period.  A later per-entity step
    # shuffles the period rows only.
    return raw.groupBy(*keys, period).agg(*aggs)


class DuplicatePeriodRows(ValueError):
    pass


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise if a key occurs twice (e.g. two rows for one player-season,
    which would give two entity rows that multiply at the next join).
    One aggregation; stops at the first duplicate found."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).limit(1).collect()
    if dup:
        raise DuplicatePeriodRows(f"duplicate rows for {dict(zip(keys, dup[0][:len(keys)]))}")
    return df


def cumulate_step(prev: DataFrame | None, cur: DataFrame, *, keys: Sequence[str], period: str,
                  history_col: str, snapshot_col: str, attrs: Sequence[str] = (),
                  mode: str = "accumulate", latest: Sequence[str] = (),
                  current: Mapping[str, object] | None = None, active_col: str = "is_active",
                  since_col: str | None = None, keys_not_null: bool = False) -> DataFrame:
    """One period of a cumulative dimension.

    ``prev``: snapshot t-1 (or ``None`` for the first load); ``cur``: period
    rows of t from :func:`period_items`.  ``latest`` columns take the new
    value when present, else the old one; ``current`` columns take the new
    value or, when the entity is absent, the given default.

    ``prev`` should be a stored partition (or a ``checkpoint()``): the step
    reads it more than once, so chaining steps in memory grows the plan
    with every period.  ``sinks.publish.load_periods`` does exactly that.
    """
    if mode not in ("accumulate", "replace"):
        raise ValueError(f"mode must be 'accumulate' or 'replace', not {mode!r}")
    current = dict(current or {})
    if prev is None:
        cols = [F.col(k) for k in keys] + [F.col(a) for a in attrs] + [F.col(history_col)]
        cols += [F.col(x) for x in latest]
        cols += [F.coalesce(F.col(n), F.lit(d)).alias(n) for n, d in current.items()]
        cols.append(F.lit(True).alias(active_col))
        if since_col:
            cols.append(F.lit(0).alias(since_col))
        cols.append(F.col(period).alias(snapshot_col))
        return cur.select(*cols)

    def project(p, c):
        present = c(period).isNotNull()
        if mode == "accumulate":
            hist = (F.when(~present, p(history_col))
                    .when(p(history_col).isNull(), c(history_col))
                    .otherwise(F.concat(c(history_col), p(history_col))))
        else:
            hist = F.coalesce(c(history_col), p(history_col))
        cols = [F.coalesce(p(k), c(k)).alias(k) for k in keys]
        cols += [F.coalesce(p(a), c(a)).alias(a) for a in attrs]
        cols.append(hist.alias(history_col))
        cols += [F.coalesce(c(x), p(x)).alias(x) for x in latest]
        cols += [F.when(present, c(n)).otherwise(F.lit(d)).alias(n) for n, d in current.items()]
        cols.append(present.alias(active_col))
        if since_col:
            cols.append(F.when(present, F.lit(0)).otherwise(p(since_col) + 1).alias(since_col))
        cols.append(F.coalesce(c(period), p(snapshot_col) + 1).alias(snapshot_col))
        return cols

    return full_outer(prev, cur, keys, project, keys_not_null=keys_not_null)


def cumulate_backfill(rows: DataFrame, *, keys: Sequence[str], period: str, history_col: str | None,
                      snapshot_col: str, lo: int, hi: int, attrs: Sequence[str] = (),
                      mode: str = "accumulate", latest: Sequence[str] = (),
                      current: Mapping[str, object] | None = None, active_col: str = "is_active",
                      since_col: str | None = None, snapshots: str = "all") -> DataFrame:
    """Closed form of running :func:`cumulate_step` for periods ``lo..hi``
    starting from an empty table.

    ``rows``: one row per (entity, period) from :func:`period_items`.
    ``snapshots='all'`` returns every snapshot (one row per entity per
    period since its first appearance); ``'last'`` only snapshot ``hi``.
    ``history_col=None`` leaves the history out, so that only the period and
    the named columns are collected per entity (what a type-2 load needs).

    A row with a NULL key never meets another one, as in the step: each
    (NULL key, period) is an entity of its own.
    """
    if mode not in ("accumulate", "replace"):
        raise ValueError(f"mode must be 'accumulate' or 'replace', not {mode!r}")
    current = dict(current or {})
    fields = [period, *([history_col] if history_col else []), *attrs, *latest, *current.keys()]
    rows = rows.where(F.col(period).between(lo, hi))
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    h = rows.groupBy(*keys, F.when(null_key, F.col(period)).alias("_own")).agg(
        F.sort_array(F.collect_list(F.struct(*[F.col(f) for f in fields]))).alias("_h"))

    t = F.col("_t")
    if snapshots == "all":
        h = h.select(*keys, "_h", F.explode(F.sequence(F.col("_h")[0][period], F.lit(hi))).alias("_t"))
    elif snapshots == "last":
        h = h.select(*keys, "_h", F.lit(hi).alias("_t"))
    else:
        raise ValueError("snapshots must be 'all' or 'last'")

    upto = F.filter("_h", lambda x: x[period] <= t)
    h = h.select(*keys, "_t", upto.alias("_u"))
    u = F.col("_u")
    last = F.element_at(u, -1)          # non-empty: t >= first period
    active = last[period] == t

    if not history_col:
        hist = None
    elif mode == "accumulate":
        hist = F.flatten(F.reverse(F.transform(u, lambda x: x[history_col])))
    else:
        hist = last[history_col]

    def first_non_null(a):
        return F.get(F.filter(u, lambda x: x[a].isNotNull()), 0)[a]

    def last_non_null(a):
        return F.try_element_at(F.filter(u, lambda x: x[a].isNotNull()), F.lit(-1))[a]

    cols = [F.col(k) for k in keys]
    cols += [first_non_null(a).alias(a) for a in attrs]
    if history_col:
        cols.append(hist.alias(history_col))
    cols += [last_non_null(x).alias(x) for x in latest]
    cols += [F.when(active, last[n]).otherwise(F.lit(d)).alias(n) for n, d in current.items()]
    cols.append(active.alias(active_col))
    if since_col:
        cols.append((t - last[period]).cast("int").alias(since_col))
    cols.append(t.cast("int").alias(snapshot_col))
    return h.select(*cols)


# --- the two shapes used by the modelling scripts -------------------------

PLAYER_ATTRS = ("height", "college", "country", "draft_year")
SEASON_FIELDS = ("season", "age", "gp", "pts", "reb", "ast")


def players_cumulated(player_seasons: DataFrame, lo: int, hi: int, snapshots: str = "all",
                      attrs: Sequence[str] = PLAYER_ATTRS,
                      season_fields: Sequence[str] = SEASON_FIELDS) -> DataFrame:
    """Player dimension: attributes, ``seasons`` array (newest
    first), ``is_active``, ``years_since_last_active``, ``current_season``."""
    rows = period_items(player_seasons, keys=["player_name"], period="season", item_cols=season_fields,
                        history_col="seasons", attrs=attrs, unique_per_period=True)
    return cumulate_backfill(rows, keys=["player_name"], period="season", history_col="seasons",
                             snapshot_col="current_season", lo=lo, hi=hi, attrs=attrs,
                             since_col="years_since_last_active", snapshots=snapshots)


def players_activity(player_seasons: DataFrame, lo: int, hi: int) -> DataFrame:
    """``player_name, is_active, current_season`` of every snapshot: what a
    type-2 load reads, without collecting the seasons' payload."""
    return cumulate_backfill(player_seasons.select("player_name", "season"), keys=["player_name"], period="season",
                             history_col=None, snapshot_col="current_season", lo=lo, hi=hi)


FILM_FIELDS = ("film", "year", "votes", "rating", "film_id")


def actor_period_rows(actor_films: DataFrame) -> DataFrame:
    """Films of an actor-year as an array plus the year's quality band
    (average rating on exact decimals, so the band edges are exact)."""
    from dimforge.functions.scalars import band
    return period_items(actor_films, keys=["actor_id"], period="year", item_cols=FILM_FIELDS,
                        history_col="films", attrs=["actor"],
                        period_aggs={"quality_class": band(F.avg(F.col("rating").cast("decimal(4,1)")))})


def actor_period_state(actor_films: DataFrame) -> DataFrame:
    """The actor-year's name, film count and quality band, without the films."""
    from dimforge.functions.scalars import band
    return actor_films.groupBy("actor_id", "year").agg(
        F.min("actor").alias("actor"), F.count(F.lit(1)).cast("int").alias("n_films"),
        band(F.avg(F.col("rating").cast("decimal(4,1)"))).alias("quality_class"))


def actors_state(actor_films: DataFrame, lo: int, hi: int) -> DataFrame:
    """``actor_id, actor, quality_class, is_active, current_year`` of every
    snapshot (class carried), without collecting any film."""
    return cumulate_backfill(actor_period_state(actor_films), keys=["actor_id"], period="year", history_col=None,
                             snapshot_col="current_year", lo=lo, hi=hi, attrs=["actor"], mode="replace",
                             latest=["quality_class"])


def actors_cumulated(actor_films: DataFrame, lo: int, hi: int, mode: str = "replace",
                     snapshots: str = "all") -> DataFrame:
    """``actors``-shaped table.  ``accumulate``: films of the year prepended,
    class of the year ('bad' when inactive).  ``replace``: the latest active
    year's films and class are carried."""
    rows = actor_period_rows(actor_films)
    if mode == "accumulate":
        return cumulate_backfill(rows, keys=["actor_id"], period="year", history_col="films",
                                 snapshot_col="current_year", lo=lo, hi=hi, attrs=["actor"],
                                 mode="accumulate", current={"quality_class": "bad"}, snapshots=snapshots)
    return cumulate_backfill(rows, keys=["actor_id"], period="year", history_col="films",
                             snapshot_col="current_year", lo=lo, hi=hi, attrs=["actor"],
                             mode="replace", latest=["quality_class"], snapshots=snapshots)
