"""Analyses over the modelled tables: streak / threshold reports with top-k,
global dense rank, array explode and array folds, column profile.

Global rankings never move every row into one task:

* ``dense_rank_topk`` keeps the k best *distinct* values (top-k per task,
  merged: bounded by k), ranks those k values and broadcasts them back.
* ``dense_rank_all`` ranks every row by ranking only the distinct values:
  a proven-small set in one window, a large one range-partitioned, each
  range ranked in its own task and shifted by the number of values before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimforge.operators.joins import bounded_count, broadcast_if_small
from dimforge.session import shared_dir


def _order(col: str, descending: bool) -> Column:
    """NULL ranks last in either direction."""
    return F.col(col).desc_nulls_last() if descending else F.col(col).asc_nulls_last()


def dense_rank_topk(df: DataFrame, col: str, k: int, rank_col: str = "ranking",
                    descending: bool = True) -> DataFrame:
    """Rows whose DENSE_RANK over ``col`` is at most ``k`` (ties kept, NULL
    ranks last).  ``df`` is read twice: pass a stored or checkpointed table if
    it is expensive."""
    top = df.select(F.col(col).alias("_v")).distinct().orderBy(_order("_v", descending)).limit(k)
    ranked = top.withColumn(rank_col, F.dense_rank().over(Window.orderBy(_order("_v", descending))).cast("int"))
    return df.join(F.broadcast(ranked), df[col].eqNullSafe(ranked["_v"])).drop("_v")       # k rows at most


def dense_rank_all(df: DataFrame, col: str, rank_col: str = "ranking", descending: bool = True,
                   ranges: int | None = None, small_values: int = 100_000) -> DataFrame:
    """DENSE_RANK over the whole table for a column of any orderable type,
    without a single-partition window over the rows.  NULL ranks last.

    Only the *distinct values* are ranked.  When a bounded probe proves there
    are at most ``small_values`` of them, they are ranked in one small window
    and broadcast back.  Otherwise they are range-partitioned, written once
    with ``checkpoint()`` (so ranks and offsets see the same ranges), ranked
    per range in parallel and shifted by the number of values before."""
    vals = df.select(F.col(col).alias("_v")).distinct()
    order = _order("_v", descending)
    if bounded_count(vals, small_values) <= small_values:
        ranks = F.broadcast(vals.withColumn(rank_col, F.dense_rank().over(Window.orderBy(order)).cast("int")))
        return df.join(ranks, df[col].eqNullSafe(ranks["_v"]), "left").drop("_v")
    shared_dir(df.sparkSession)                       # registers the checkpoint folder
    dealt = vals.repartitionByRange(ranges, order) if ranges else vals.repartitionByRange(order)
    vals = dealt.withColumn("_r", F.spark_partition_id()).checkpoint()
    local = vals.withColumn("_lr", F.row_number().over(Window.partitionBy("_r").orderBy(order)))
    sizes = vals.groupBy("_r").agg(F.count(F.lit(1)).alias("_n"))       # one row per range
    offs = sizes.select(F.col("_r").alias("_or"), F.coalesce(F.sum("_n").over(
        Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    ranks = (local.join(broadcast_if_small(offs), F.col("_r") == F.col("_or"))
                  .select(F.col("_v"), (F.col("_off") + F.col("_lr")).cast("int").alias(rank_col)))
    # One row per distinct value: AQE turns this join into a broadcast when
    # the measured side is small and splits a hot value's partition otherwise.
    return df.join(ranks, df[col].eqNullSafe(ranks["_v"]), "left").drop("_v")


def _once(per_entity: DataFrame) -> DataFrame:
    """Written once (one row per entity), as ranking reads it twice."""
    shared_dir(per_entity.sparkSession)
    return per_entity.checkpoint()


def threshold_report(df: DataFrame, *, key: str, period: str, value: str, threshold: float,
                     k: int, count_col: str = "consecutive_seasons_over_20",
                     start_col: str = "season_start", end_col: str = "season_end",
                     rank_col: str = "ranking") -> DataFrame:
    """The script's report as written: per entity the *number* of periods
    with ``value >= threshold`` (its column name says "consecutive"), first
    and last period, dense-ranked, rank <= k.  (The script's LAG flag and
    running sum never reach the output, so they are not computed.)"""
    agg = df.groupBy(key).agg(F.count_if(F.col(value) >= threshold).cast("bigint").alias(count_col),
                              F.min(period).alias(start_col), F.max(period).alias(end_col))
    return dense_rank_topk(_once(agg), count_col, k, rank_col).select(key, count_col, start_col, end_col, rank_col)


def longest_streaks(df: DataFrame, *, key: str, period: str, value: str, threshold: float, k: int,
                    len_col: str = "longest_streak", start_col: str = "streak_start",
                    end_col: str = "streak_end", rank_col: str = "ranking") -> DataFrame:
    """Real runs of consecutive periods with ``value >= threshold``: the
    longest per entity (earliest on ties), dense-ranked, rank <= k.

    Islands: period - row_number() is constant along a run of consecutive
    periods.  Window, run grouping and per-entity pick share one exchange."""
    hits = df.where(F.col(value) >= threshold).select(key, period)
    w = Window.partitionBy(key).orderBy(period)
    isl = hits.withColumn("_i", F.col(period) - F.row_number().over(w))
    runs = isl.groupBy(key, "_i").agg(F.count(F.lit(1)).cast("int").alias("_len"),
                                       F.min(period).alias("_s"), F.max(period).alias("_e"))
    best = runs.groupBy(key).agg(F.max(F.struct(F.col("_len"), (-F.col("_s")).alias("_ns"),
                                                F.col("_s"), F.col("_e"))).alias("_b"))
    best = best.select(key, F.col("_b._len").alias(len_col), F.col("_b._s").alias(start_col),
                       F.col("_b._e").alias(end_col))
    return dense_rank_topk(_once(best), len_col, k, rank_col)


def explode_history(dim: DataFrame, array_col: str, keep: Sequence[str],
                    fields: Sequence[str] | None = None) -> DataFrame:
    """Array of structs -> one row per element with its fields as columns
    (CROSS JOIN UNNEST: rows with NULL or empty arrays disappear).

    With ``fields`` only those struct fields are returned: the per-field
    arrays (``arr.f``) are zipped and exploded, so nested-column pruning
    reads just those fields from Parquet (``inline`` reads every field).
    Rows with a NULL array still disappear; a NULL *element* becomes a row
    of NULL fields, as with ``inline``."""
    if fields is None:
        return dim.select(*keep, F.inline(array_col))
    zipped = F.arrays_zip(*[F.col(f"{array_col}.{f}").alias(f) for f in fields])
    return dim.select(*keep, F.inline(zipped))


def fold_array(dim: DataFrame, keep: Sequence[str], fields: Sequence[str], array_col: str, zero: Column,
               merge, out: str) -> DataFrame:
    """REDUCE over an array of structs without a shuffle.  Only ``fields`` are
    zipped (``arrays_zip`` of the field arrays), so nested-column pruning
    still reads just those fields."""
    zipped = F.arrays_zip(*[F.col(f"{array_col}.{f}").alias(f) for f in fields])
    return dim.select(*keep, F.aggregate(zipped, zero, merge).alias(out))


def profile(df: DataFrame, columns: Sequence[str] | None = None, exact_distinct: bool = False) -> DataFrame:
    """Column statistics in one aggregation pass, one output row per column:
    rows, NULLs, distinct values (HyperLogLog++ unless ``exact_distinct``),
    min and max as text."""
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        col = F.col(c)
        aggs += [F.count_if(col.isNull()).alias(f"_n{i}"),
                 (F.countDistinct(col) if exact_distinct else F.approx_count_distinct(col)).alias(f"_d{i}"),
                 F.min(col).cast("string").alias(f"_lo{i}"), F.max(col).cast("string").alias(f"_hi{i}")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").cast("bigint").alias("n_nulls"),
                              F.col(f"_d{i}").cast("bigint").alias("n_distinct"),
                              F.col(f"_lo{i}").alias("min_value"), F.col(f"_hi{i}").alias("max_value"))
                     for i, c in enumerate(columns)])
    return one.select(F.col("_rows").cast("bigint").alias("n_rows"), F.inline(rows)) \
              .select("column_name", "n_rows", "n_nulls", "n_distinct", "min_value", "max_value")
