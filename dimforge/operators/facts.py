"""Fact tables: typed build, de-duplication and reduced facts.

* ``build_game_fact`` — games ⋈ box scores into a ``fct_`` table with ids
  first, ``dim_`` dimensions and ``m_`` measures (names checked by
  ``lint_fact_columns``).
* ``dedupe_first`` — first row per key under a total order.  ``row_number() =
  1`` is planned with a partial ``WindowGroupLimit`` before the exchange, so
  a key with millions of copies ships at most one row per map task.
* ``duplicates`` / ``duplicate_counts`` — the inspection queries.  For keys
  only, the extra rows are re-generated from per-key counts (partial
  aggregation, then chunked range expansion spread over tasks); full rows
  are numbered with hot keys split into range chunks.  Neither sorts a hot
  key in one task.
* ``daily_metric`` / ``metric_totals`` — the daily reduced fact and its check.
* ``monthly_array_step`` / ``monthly_array_backfill`` — one array of daily
  values per (user, metric, month).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimforge.functions.scalars import clock_to_seconds, day_of
from dimforge.operators.joins import full_outer

# --- fact build --------------------------------------------------------------

# Box-score column -> fact measure name (all stored as DOUBLE).
GAME_MEASURES = {
    "fgm": "m_field_goals_made", "fga": "m_field_goals_attempted",
    "fg3m": "m_three_pointers_made", "fg3a": "m_three_pointers_attempted",
    "ftm": "m_free_throws_made", "fta": "m_free_throws_attempted",
    "oreb": "m_offensive_rebounds", "dreb": "m_defensive_rebounds", "reb": "m_rebounds",
    "ast": "m_assists", "stl": "m_steals", "blk": "m_blocks", "to": "m_turnovers",
    "pf": "m_personal_fouls", "pts": "m_points", "plus_minus": "m_plus_minus",
}


GAME_DIMENSIONS = {"team_abbreviation": "dim_team_abbreviation", "player_name": "dim_player_name",
                   "start_position": "dim_start_position"}


def lint_fact_columns(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Fact naming convention: ids first, then only ``dim_`` / ``m_`` columns."""
    cols = df.columns
    if list(cols[:len(ids)]) != list(ids):
        raise ValueError(f"fact ids must come first: {cols[:len(ids)]} != {list(ids)}")
    bad = [c for c in cols[len(ids):] if not (c.startswith("dim_") or c.startswith("m_"))]
    if bad:
        raise ValueError(f"fact columns without dim_/m_ prefix: {bad}")
    return df


def build_game_fact(games: DataFrame, details: DataFrame,
                    measures: Mapping[str, str] | None = None,
                    dimensions: Mapping[str, str] | None = None) -> DataFrame:
    """``fct_game_details``: one row per box-score line with its game's date,
    season and the team's win flag.  ``measures`` and ``dimensions`` map
    columns of ``details`` to fact columns; a declared column that is missing
    raises."""
    measures = GAME_MEASURES if measures is None else measures
    dimensions = GAME_DIMENSIONS if dimensions is None else dimensions
    missing = [c for c in [*measures, *dimensions] if c not in details.columns]
    if missing:
        raise ValueError(f"columns missing from the box scores: {missing}")
    g = games.select("game_id", "game_date_est", "season", "home_team_wins", "home_team_id").alias("g")
    d = details.alias("gd")
    j = g.join(d, F.col("g.game_id") == F.col("gd.game_id"))
    dims = [F.col(f"gd.{src}").alias(name) for src, name in dimensions.items()]
    comment = F.col("gd.comment")
    win = F.when(F.col("gd.team_id") == F.col("g.home_team_id"), F.col("g.home_team_wins") == 1) \
           .otherwise(F.col("g.home_team_wins") == 0)
    out = j.select(
        F.col("g.game_id").alias("game_id"), F.col("gd.team_id").alias("team_id"),
        F.col("gd.player_id").alias("player_id"),
        *dims,
        comment.like("%DND%").alias("dim_did_not_dress"),
        comment.like("%NWT%").alias("dim_not_with_team"),
        clock_to_seconds(F.col("gd.min")).alias("m_seconds_played"),
        *[F.col(f"gd.{src}").cast("double").alias(name) for src, name in measures.items()],
        F.col("g.game_date_est").alias("dim_game_date"),
        F.col("g.season").alias("dim_season"),
        win.alias("dim_team_did_win"),
    )
    return lint_fact_columns(out, ["game_id", "team_id", "player_id"])


# --- de-duplication ------------------------------------------------------------

def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                 row_col: str | None = None) -> DataFrame:
    """Keep row number 1 per key.  ``order`` must make the order total when
    non-key columns are kept (otherwise the survivor is arbitrary)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return out.withColumnRenamed("_rn", row_col) if row_col else out.drop("_rn")


def expand_ranges(df: DataFrame, lo: str, hi: str, out: str, chunk: int = 1 << 16) -> DataFrame:
    """One row per integer in ``[lo, hi]`` for every input row.  Large ranges
    are cut into chunks that are spread over tasks before expansion, so no
    single task materialises a huge array."""
    c = df.withColumn("_c", F.explode(F.sequence(F.lit(0), F.floor((F.col(hi) - F.col(lo)) / chunk).cast("bigint"))))
    c = c.withColumn("_a", F.col(lo) + F.col("_c") * chunk) \
         .withColumn("_b", F.least(F.col(hi), F.col("_a") + chunk - 1))
    c = c.repartition("_a", *[x for x in df.columns if x not in (lo, hi)])
    return c.withColumn(out, F.explode(F.sequence("_a", "_b"))).drop("_c", "_a", "_b")


def duplicate_counts(df: DataFrame, keys: Sequence[str], count_col: str = "counts") -> DataFrame:
    """Rows per key, most duplicated first."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).orderBy(F.col(count_col).desc(), *keys)


def duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None,
               row_col: str = "row_num") -> DataFrame:
    """Rows whose number within their key is not 1.

    Without ``order`` only keys are returned (the rows are indistinguishable):
    per-key counts expanded to row numbers 2..n — skew-safe.  With ``order``
    full rows are numbered by ``row_number``; keys above the hot-row
    threshold are split into range chunks (``operators.windows``)."""
    if order is None:
        c = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1) \
              .withColumn("_lo", F.lit(2).cast("bigint"))
        return expand_ranges(c, "_lo", "_n", row_col).select(*keys, F.col(row_col).cast("int").alias(row_col))
    from dimforge.operators.windows import rank_within
    return rank_within(df, key=list(keys), order=list(order), out=row_col, kind="row_number") \
        .where(F.col(row_col) != 1)


# --- reduced facts -------------------------------------------------------------

def daily_metric(events: DataFrame, *, user_col: str, ts_col: str, name: str, cond: Column,
                 day_lo=None, day_hi=None) -> DataFrame:
    """(user, metric_name, metric_value, date): rows meeting ``cond`` per
    user-day; user-days with events but no match are kept with 0."""
    day = day_of(ts_col)
    if day_lo is not None:
        events = events.where(day.between(F.lit(day_lo).cast("date"), F.lit(day_hi).cast("date")))
    return (events.groupBy(F.col(user_col).alias("user_id"), day.alias("date"))
                  .agg(F.count_if(cond).cast("bigint").alias("metric_value"))
                  .select("user_id", F.lit(name).alias("metric_name"), "metric_value", "date"))


def metric_totals(daily: DataFrame) -> DataFrame:
    """SUM of the metric per (date, metric), largest first."""
    return (daily.groupBy("date", "metric_name").agg(F.sum("metric_value").cast("bigint").alias("metric_value"))
                 .orderBy(F.col("metric_value").desc(), "date"))


def monthly_array_step(prev: DataFrame | None, daily: DataFrame, *, day, month_start,
                       as_written: bool = False) -> DataFrame:
    """Append one day's metric values to the month's arrays.

    Intended form: existing arrays get the day's value or 0 appended; a key
    first seen today gets zeros for the earlier days of the month.
    ``as_written``: the script's stub — a one-element array of the day's
    value (the previous array is not carried).

    Idempotent: if the array already holds the day, its slot is replaced; if
    days between are missing the step raises."""
    d = F.lit(day).cast("date")
    ms = F.lit(month_start).cast("date")
    today = daily.where(F.col("date") == d).select("user_id", "metric_name", "metric_value")
    keys = ["user_id", "metric_name"]
    if prev is None:
        prev = today.sparkSession.createDataFrame(
            [], "user_id bigint, metric_name string, metric_array array<bigint>, month_start string")
    prev = prev.where(F.col("month_start") == F.date_format(ms, "yyyy-MM-dd")) \
               .select("user_id", "metric_name", "metric_array")

    def project(y, t):
        if as_written:
            arr = F.array(t("metric_value"))
        else:
            val = F.array(F.coalesce(t("metric_value"), F.lit(0).cast("bigint")))
            at = F.datediff(d, ms)
            old = y("metric_array")
            lead = F.array_repeat(F.lit(0).cast("bigint"), at)
            gap = F.raise_error(F.format_string("metric array holds %d days, %s needs %d", F.size(old),
                                                d.cast("string"), at)).cast("array<bigint>")
            arr = (F.when(old.isNull(), F.concat(lead, val)).when(F.size(old) < at, gap)
                    .otherwise(F.concat(F.slice(old, F.lit(1), at), val,
                                        F.slice(old, at + 2, F.greatest(F.size(old) - at - 1, F.lit(0))))))
        return [*[F.coalesce(t(k), y(k)).alias(k) for k in keys], arr.alias("metric_array"),
                F.date_format(ms, "yyyy-MM-dd").alias("month_start")]

    return full_outer(prev, today, keys, project)


def monthly_array_backfill(daily: DataFrame, *, month_start, through) -> DataFrame:
    """Closed form of the intended step for every day ``month_start..through``:
    one exchange on (user, metric); the array is filled from a day -> value
    map inside the task (at most 31 entries)."""
    ms = F.lit(month_start).cast("date")
    th = F.lit(through).cast("date")
    rows = daily.where(F.col("date").between(ms, th))
    # A NULL user never matches the previous day's row, so each of its days
    # stays a separate row (as the step's SQL join does).
    rows = rows.withColumn("_nk", F.when(F.col("user_id").isNull(), F.col("date")))
    g = rows.groupBy("user_id", "metric_name", "_nk").agg(
        F.map_from_entries(F.collect_list(F.struct(F.datediff("date", ms), "metric_value"))).alias("_m"))
    arr = F.transform(F.sequence(F.lit(0), F.datediff(th, ms)),
                      lambda i: F.coalesce(F.col("_m")[i], F.lit(0).cast("bigint")))
    return g.select("user_id", "metric_name", arr.alias("metric_array"),
                    F.date_format(ms, "yyyy-MM-dd").alias("month_start"))
