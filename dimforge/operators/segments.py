"""Histories longer than one row should hold.

An array per entity is bounded by the entity's rows, which a hot actor or the
NULL user does not bound.  Here a history is stored in numbered segments of at
most ``size`` items: row ``(keys, segment)`` holds items ``segment * size`` to
``(segment + 1) * size - 1`` of the entity's order.  Rows are numbered by
:func:`dimforge.operators.windows.rank_within`, which splits a hot key into
chunks, so a key's segments are built and kept in many tasks; the segments of
an entity, one after the other, are the plain list.

``append_segments`` adds items at the end without reading full segments;
``fold_segments`` reads values off all items of an entity: an expression per
segment, then an aggregate of its values (narrow rows).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.operators.windows import HOT_ROWS, rank_within

SEGMENT = 1000


def segments(df: DataFrame, *, keys: Sequence[str], order: Sequence[str], item_cols: Sequence[str], size: int = SEGMENT,
             items_col: str = "items", hot_rows: int = HOT_ROWS, chunks: int | None = None) -> DataFrame:
    """``keys, segment, items`` (structs of ``item_cols`` by ``order``; NULL
    first).  Equal rows of an entity in one order position are interchangeable,
    so ``order`` should name the items fully."""
    need = list(dict.fromkeys([*keys, *order, *item_cols]))
    numbered = rank_within(df.select(*need), key=list(keys), order=[F.col(c).asc_nulls_first() for c in order],
                           out="_no", kind="row_number", hot_rows=hot_rows, chunks=chunks)
    return _gathered(numbered.withColumn("_no", F.col("_no").cast("long") - 1), keys, item_cols, size, items_col)


def _gathered(numbered: DataFrame, keys, item_cols, size: int, items_col: str) -> DataFrame:
    """Items by their number (from 0) into segments."""
    item = F.struct("_no", F.struct(*[F.col(c) for c in item_cols]).alias("item"))
    rows = numbered.groupBy(*keys, F.floor(F.col("_no") / size).cast("long").alias("segment")).agg(
        F.sort_array(F.collect_list(item)).alias("_i"))                      # at most `size` items
    return rows.select(*keys, "segment", F.transform("_i", lambda i: i["item"]).alias(items_col))


def append_segments(stored: DataFrame, df: DataFrame, *, keys: Sequence[str], order: Sequence[str],
                    item_cols: Sequence[str], size: int = SEGMENT, items_col: str = "items",
                    hot_rows: int = HOT_ROWS, chunks: int | None = None) -> DataFrame:
    """The segments that change when the rows of ``df`` follow all stored items
    of their entities: the open last segment of each (rewritten), and new ones.
    Full segments are neither shuffled nor written."""
    last = stored.groupBy(*keys).agg(F.max_by(F.struct("segment", F.size(items_col).alias("n")), "segment").alias("_l"))
    last = last.select(*[F.col(k).alias(f"_{k}") for k in keys],
                       (F.col("_l.segment") * size + F.col("_l.n")).alias("_have"))
    need = list(dict.fromkeys([*keys, *order, *item_cols]))
    numbered = rank_within(df.select(*need), key=list(keys), order=[F.col(c).asc_nulls_first() for c in order],
                           out="_no", kind="row_number", hot_rows=hot_rows, chunks=chunks)
    same = _and([numbered[k].eqNullSafe(last[f"_{k}"]) for k in keys])
    numbered = numbered.join(last, same, "left").withColumn(
        "_no", F.coalesce("_have", F.lit(0)).cast("long") + F.col("_no") - 1).select(*keys, "_no", *item_cols_of(item_cols, keys))
    entities = df.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    is_open = stored.where(F.size(items_col) < size)
    is_open = is_open.join(entities, _and([is_open[k].eqNullSafe(entities[f"_{k}"]) for k in keys]), "left_semi")
    held = is_open.select(*keys, "segment", F.posexplode(items_col).alias("_at", "_item")).select(
        *keys, (F.col("segment") * size + F.col("_at")).alias("_no"), *[F.col(f"_item.{c}").alias(c) for c in item_cols_of(item_cols, keys)])
    return _gathered(numbered.unionByName(held), keys, item_cols, size, items_col)


def item_cols_of(item_cols: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Item columns that are not keys."""
    return [c for c in item_cols if c not in keys]


def _and(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def fold_segments(stored: DataFrame, *, keys: Sequence[str], per_segment: Mapping[str, Column],
                  across: Mapping[str, Column]) -> DataFrame:
    """One row per entity: ``per_segment`` expressions on a segment's array,
    then ``across`` aggregates of them."""
    values = stored.select(*keys, "segment", *[e.alias(n) for n, e in per_segment.items()])
    return values.groupBy(*keys).agg(*[e.alias(n) for n, e in across.items()])
