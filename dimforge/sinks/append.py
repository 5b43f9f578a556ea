"""Facts that arrive in loads and are stored once per key.

``append_new`` keeps the first row of each key ever loaded.  A load probes only
the stored partitions its own rows belong to, and inside them only row groups
whose key bounds it can meet: files are written sorted by key.  Running a load
again adds nothing, so a load that failed is run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimforge.operators.facts import dedupe_first
from dimforge.sinks.publish import path_exists

ORDERED = (T.IntegralType, T.StringType, T.DateType, T.TimestampType)


def stored_keys(load: DataFrame, path: str, keys: Sequence[str], partition: str) -> DataFrame:
    """Keys of the table that rows of ``load`` may share: of the load's
    partitions only (one value per partition reaches the driver) and inside the
    bounds of its keys, which are compared with row-group statistics.  Bounds
    are taken of key columns of whole, text, day and time types without NULL."""
    spark = load.sparkSession
    bounded = [k for k in keys if isinstance(load.schema[k].dataType, ORDERED)]
    bounds = [F.struct(F.min(k).alias("lo"), F.max(k).alias("hi"), F.count_if(F.col(k).isNull()).alias("nulls")).alias(f"_{i}")
              for i, k in enumerate(bounded)]
    per = load.groupBy(partition).agg(F.count(F.lit(1)).alias("_n"), *bounds).collect()
    there = F.lit(False)
    values = [r[partition] for r in per]
    if values:
        there = F.col(partition).isin([v for v in values if v is not None])
        there = there | F.col(partition).isNull() if None in values else there
    for i, k in enumerate(bounded):
        spans = [r[f"_{i}"] for r in per]
        if spans and not any(x["nulls"] for x in spans):
            there = there & F.col(k).between(min(x["lo"] for x in spans), max(x["hi"] for x in spans))
    fields = [f for f in load.schema.fields if f.name in {*keys, partition}]
    return spark.read.schema(T.StructType(fields)).parquet(path).where(there).select(*keys, partition)


def new_rows(load: DataFrame, path: str, *, keys: Sequence[str], partition: str, order: Sequence[Column | str]) -> DataFrame:
    """The rows of ``load`` that ``append_new`` adds.  Stored keys come first of
    the rows of their key, so rows and stored keys are shuffled once."""
    if not path_exists(load.sparkSession, path):
        return dedupe_first(load, keys, order)
    known = stored_keys(load, path, keys, partition).withColumn("_new", F.lit(False))
    rows = load.withColumn("_new", F.lit(True)).unionByName(known, allowMissingColumns=True)
    return dedupe_first(rows, keys, ["_new", *order]).where("_new").drop("_new")


def append_new(load: DataFrame, path: str, *, keys: Sequence[str], partition: str, order: Sequence[Column | str]) -> None:
    """Add the rows of ``load`` whose key is not stored, one per key (the first
    by ``order``, which should be total).

    ``partition`` follows from the key: rows with one key have one value of it,
    so no other partition can hold the key.  A NULL key is a key.  ``load`` is
    read twice (key bounds, rows): pass a stored table."""
    first = new_rows(load, path, keys=keys, partition=partition, order=order)
    (first.hint("rebalance", partition).sortWithinPartitions(partition, *keys)
          .write.mode("append").partitionBy(partition).parquet(path))
