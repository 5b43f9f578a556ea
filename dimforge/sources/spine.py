"""Generated period spines (``sequence(a, b)`` used as a table).

``spark.range`` generates the rows in parallel tasks; nothing is built on
the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def int_spine(spark: SparkSession, lo: int, hi: int, name: str = "period") -> DataFrame:
    """Integers ``lo..hi`` inclusive."""
    return spark.range(lo, hi + 1).select(F.col("id").cast("int").alias(name))


def date_spine(spark: SparkSession, lo: str, hi: str, name: str = "date") -> DataFrame:
    """Days ``lo..hi`` inclusive."""
    n = spark.range(1).select(F.datediff(F.lit(hi).cast("date"), F.lit(lo).cast("date"))).first()[0]
    return spark.range(0, n + 1).select(F.date_add(F.lit(lo).cast("date"), F.col("id").cast("int")).alias(name))


def entity_spine(df: DataFrame, keys, period: str, hi=None, name: str | None = None) -> DataFrame:
    """Per entity, every period from its first to its last (or ``hi``) —
    the rows a spine-based SCD or datelist is evaluated on."""
    name = name or period
    g = df.groupBy(*keys).agg(F.min(period).alias("_lo"), F.max(period).alias("_hi"))
    end = F.col("_hi") if hi is None else F.lit(hi).cast(df.schema[period].dataType)
    return g.select(*keys, F.explode(F.sequence(F.col("_lo"), end)).alias(name))
