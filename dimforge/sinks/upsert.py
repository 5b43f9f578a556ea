"""Inserts, updates and deletes by key into a partitioned Parquet table.

Only partitions that hold a changed key, or get one, are read whole and
rewritten; all other partitions keep their files.  There is no log and no table
format: applying the same change set again leaves the same table, so a load
that was stopped is run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.operators.joins import broadcast_if_small
from dimforge.session import shared_dir
from dimforge.sinks.publish import path_exists, publish


def last_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One change per key: the greatest by ``order``, then by the whole row."""
    rest = [c for c in changes.columns if c not in keys and c not in order]
    top = changes.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_top"))
    return top.select(*keys, *[F.col(f"_top.{c}").alias(c) for c in [*order, *rest]])


def apply_changes(changes: DataFrame, path: str, *, keys: Sequence[str], partition: str, deleted: str = "deleted",
                  order: Sequence[str] = ()) -> list:
    """Apply ``changes`` (the table's columns and a boolean ``deleted``; NULL:
    no) to the table at ``path`` and return the partitions rewritten.

    A change of a stored key replaces its row, also one that lies in another
    partition; of an unknown key it adds the row; a delete of an unknown key
    does nothing.  ``order``: columns of ``changes`` that tell which of several
    changes of a key is the last (they are not stored).  A NULL key is a key, a
    NULL partition a partition.

    The stored table is probed by its key and partition columns only (the
    changed keys are broadcast after a size check).  The partitions touched are
    the driver's only rows, at most one per partition of the table.  A partition
    whose rows all go stays as an empty folder."""
    spark = changes.sparkSession
    shared_dir(spark)
    changes = last_changes(changes, keys, order).drop(*order).checkpoint()
    fields = [f for f in changes.schema.fields if f.name != deleted]
    columns = [f.name for f in fields]
    gone = F.coalesce(F.col(deleted), F.lit(False))
    kept = changes.where(~gone).select(*columns)
    stored = _stored(spark, path, fields)
    changed = broadcast_if_small(changes.select(*[F.col(k).alias(f"_{k}") for k in keys]))
    same = reduce(lambda a, b: a & b, [stored[k].eqNullSafe(changed[f"_{k}"]) for k in keys])
    held = stored.select(*keys, partition).join(changed, same, "left_semi").select(partition)
    touched = [r[0] for r in held.union(kept.select(partition)).distinct().collect()]
    if not touched:
        return []
    there = F.col(partition).isin([v for v in touched if v is not None])
    if None in touched:
        there = there | F.col(partition).isNull()
    after = stored.where(there).join(changed, same, "left_anti").select(*columns).unionByName(kept)
    left = {r[0] for r in after.select(partition).distinct().collect()}
    publish(after, path, [partition])
    for v in touched:
        if v not in left:
            name = "__HIVE_DEFAULT_PARTITION__" if v is None else v
            rest = after.where("false").drop(partition)
            rest.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{partition}={name}")
    return sorted(touched, key=lambda v: (v is not None, v))


def _stored(spark: SparkSession, path: str, fields) -> DataFrame:
    from pyspark.sql.types import StructType

    schema = StructType(list(fields))
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
