"""Column statistics per partition that merge for any set of partitions.

One row per partition: rows, and per column its NULLs, minimum, maximum, a
HyperLogLog sketch and, for numbers, a KLL sketch.  They are made once per
load and stored beside the table; statistics of a date range then come from
these few rows, without reading the table.  Counts, minimum and maximum are
exact.  Distinct counts have a standard error of about 1.04 / sqrt(2^lg_k)
(1.6 % at 12); the rank of a quantile is off by at most 1.7 % at k = 200 with
a probability of 99 %.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_K = 12


def _numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def partition_statistics(df: DataFrame, by: Sequence[str], columns: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """``by`` and the mergeable statistics of ``columns``: one aggregation,
    partial before its shuffle.  A column without a value in a partition has
    NULL bounds and empty sketches."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        col = F.col(c)
        aggs += [F.count_if(col.isNull()).alias(f"{c}__nulls"), F.min(col).alias(f"{c}__min"), F.max(col).alias(f"{c}__max"),
                 F.hll_sketch_agg(col.cast("string"), F.lit(lg_k)).alias(f"{c}__hll")]
        if _numeric(df, c):
            aggs.append(F.kll_sketch_agg_double(col.cast("double")).alias(f"{c}__kll"))
    return df.groupBy(*by).agg(*aggs)


def merged_statistics(stored: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """``column_name, n_rows, n_nulls, min_value, max_value`` (text),
    ``n_distinct`` and ``quantiles`` (doubles; NULL for other types and for
    columns without a value) over the rows of ``stored``: filter them by
    partition first.  No rows give zero counts and NULL bounds."""
    aggs = [F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows")]
    for c in columns:
        aggs += [F.coalesce(F.sum(f"{c}__nulls"), F.lit(0)).cast("long").alias(f"{c}__nulls"),
                 F.min(f"{c}__min").alias(f"{c}__min"), F.max(f"{c}__max").alias(f"{c}__max"),
                 F.hll_union_agg(f"{c}__hll").alias(f"{c}__hll")]
        if f"{c}__kll" in stored.columns:
            aggs.append(F.kll_merge_agg_double(f"{c}__kll").alias(f"{c}__kll"))
    one = stored.agg(*aggs)

    def row(c):
        none = F.lit(None).cast("array<double>")
        if f"{c}__kll" in stored.columns:
            points = F.array(*[F.kll_sketch_get_quantile_double(f"{c}__kll", F.lit(float(q))) for q in quantiles])
            points = F.when(F.col(f"{c}__min").isNotNull(), points).otherwise(none)
        else:
            points = none
        return F.struct(F.lit(c).alias("column_name"), F.col("n_rows"), F.col(f"{c}__nulls").alias("n_nulls"),
                        F.col(f"{c}__min").cast("string").alias("min_value"),
                        F.col(f"{c}__max").cast("string").alias("max_value"),
                        F.coalesce(F.hll_sketch_estimate(f"{c}__hll"), F.lit(0)).cast("long").alias("n_distinct"),
                        points.alias("quantiles"))

    return one.select(F.inline(F.array(*[row(c) for c in columns])))
