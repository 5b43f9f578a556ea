"""Per-key running totals and ranks that survive a hot key.

``Window.partitionBy(key)`` sorts all rows of a key in one task.  That is fine
for keys bounded by design (one row per entity per period) but not for keys
whose row count is unbounded (films per actor, events per user).  Here:

* keys with more than ``hot_rows`` rows are found with a partially aggregated
  count (the hot-key table has at most rows / hot_rows entries; when it is
  empty, the common case, only the plain window is planned);
* ordinary keys use the plain window (each holds at most ``hot_rows`` rows);
* rows of hot keys, NULL keys included, are range-partitioned on (key, order):
  Spark's sampled bounds cut a hot key into contiguous chunks, and rows with
  equal (key, order) land in the same chunk, so RANGE-frame peers never
  straddle chunks.  The chunked rows are written once with ``checkpoint()``;
  the local windows and the chunk totals both read that copy, so they see the
  same chunks whatever columns the caller selects, and a lost executor cannot
  change them.  Each chunk is ranked / summed locally, then shifted by the
  total of the key's earlier chunks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.operators.joins import bounded_count, broadcast_if_small
from dimforge.session import shared_dir

# Rows above which a key is split into chunks.
HOT_ROWS = 5_000_000


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _same(left: DataFrame, right: DataFrame, names):
    """Null-safe equality of columns that carry a ``_`` prefix on the right."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[f"_{n}"]) for n in names])


def _split_hot(df: DataFrame, keys: list[str], hot_rows: int, max_broadcast: int = 100_000):
    """(rows of ordinary keys, rows of hot keys or None when no key is hot)."""
    hot = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
             .select(*[F.col(k).alias(f"_{k}") for k in keys]))
    n = bounded_count(hot, max_broadcast)
    if n == 0:
        return df, None
    hot = F.broadcast(hot) if n <= max_broadcast else hot
    return df.join(hot, _same(df, hot, keys), "left_anti"), df.join(hot, _same(df, hot, keys), "left_semi")


def _chunked(df: DataFrame, keys: list[str], order, local_expr, total_expr, chunks: int | None) -> DataFrame:
    """``df`` plus ``_local`` (the expression within the chunk) and ``_off``
    (the total of the key's earlier chunks; NULL if they hold no value)."""
    shared_dir(df.sparkSession)                       # registers the checkpoint folder
    ordered = df.repartitionByRange(chunks, *keys, *order) if chunks else df.repartitionByRange(*keys, *order)
    c = ordered.withColumn("_chunk", F.spark_partition_id()).checkpoint()
    local = c.withColumn("_local", local_expr.over(Window.partitionBy(*keys, "_chunk").orderBy(*order)))
    totals = c.groupBy(*keys, "_chunk").agg(total_expr.alias("_t"))          # one row per key and chunk
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offs = broadcast_if_small(totals.select(*[F.col(k).alias(f"_{k}") for k in [*keys, "_chunk"]],
                                            F.sum("_t").over(earlier).alias("_off")))
    return local.join(offs, _same(local, offs, [*keys, "_chunk"]), "left")


def running_total(df: DataFrame, *, key, order: str, value: str, out: str,
                  hot_rows: int = HOT_ROWS, chunks: int | None = None) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY key ORDER BY order)`` with the default
    RANGE frame (peers included), splitting hot keys.  As in SQL the sum is
    NULL until the first non-NULL value."""
    keys = _keys(key)
    normal, hot = _split_hot(df, keys, hot_rows)
    plain = normal.withColumn(out, F.sum(value).over(Window.partitionBy(*keys).orderBy(order)))
    if hot is None:
        return plain
    split = _chunked(hot, keys, [F.col(order)], F.sum(value), F.sum(value), chunks)
    total = F.coalesce(F.col("_local") + F.col("_off"), F.col("_local"), F.col("_off"))
    return plain.unionByName(split.select(*df.columns, total.cast(plain.schema[out].dataType).alias(out)))


def rank_within(df: DataFrame, *, key, order, out: str, hot_rows: int = HOT_ROWS,
                chunks: int | None = None, kind: str = "rank") -> DataFrame:
    """``RANK()`` (or ``ROW_NUMBER()`` with ``kind='row_number'``) ``OVER
    (PARTITION BY key ORDER BY order)``, splitting hot keys: the number is
    the local number in the chunk + the rows of the key in earlier chunks
    (equal (key, order) rows share a chunk, so ties stay exact)."""
    keys = _keys(key)
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    fn = {"rank": F.rank, "row_number": F.row_number}[kind]
    normal, hot = _split_hot(df, keys, hot_rows)
    plain = normal.withColumn(out, fn().over(Window.partitionBy(*keys).orderBy(*order)))
    if hot is None:
        return plain
    split = _chunked(hot, keys, order, fn(), F.count(F.lit(1)), chunks)
    number = (F.col("_local") + F.coalesce("_off", F.lit(0))).cast("int")
    return plain.unionByName(split.select(*df.columns, number.alias(out)))


def running_total_of_ties(df: DataFrame, *, key, order: str, value: str, out: str, hot_rows: int = HOT_ROWS,
                          chunks: int | None = None) -> DataFrame:
    """:func:`running_total` where very many rows may share one (key, order).

    With the default RANGE frame all peers of a row have one sum, so rows are
    first summed per (key, order) — partially before the shuffle —, the running
    total runs over these groups, and rows take their group's total in a join.
    Groups above ``hot_rows`` rows (at most rows / hot_rows of them) are joined
    by a checked broadcast, so their rows stay where they are; the others meet
    their group by a shuffle on (key, order)."""
    keys = _keys(key)
    cols = [*keys, order]
    groups = df.groupBy(*cols).agg(F.sum(value).alias("_v"), F.count(F.lit(1)).alias("_n"))
    totals = running_total(groups, key=keys, order=order, value="_v", out=out, hot_rows=hot_rows, chunks=chunks)
    shared_dir(df.sparkSession)
    totals = totals.select(*[F.col(c).alias(f"_{c}") for c in cols], F.col("_n") > hot_rows, out).toDF(
        *[f"_{c}" for c in cols], "_hot", out).checkpoint()
    hot = totals.where("_hot").drop("_hot")
    ordinary = totals.where("not _hot").drop("_hot")
    joined = df.join(ordinary, _same(df, ordinary, cols)).select(*df.columns, out)
    if hot.isEmpty():
        return joined
    hot = broadcast_if_small(hot)
    return joined.unionByName(df.join(hot, _same(df, hot, cols)).select(*df.columns, out))
