"""Reading the base tables.

Only ``spark.read.parquet`` — projection and filters applied afterwards are
pushed into the scan by Catalyst (``ReadSchema`` / ``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_READS: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str, refresh: bool = False) -> DataFrame:
    """Scan of a source table.  The (lazy) scan is kept per session and path,
    so repeated queries skip file listing and footer-based schema inference;
    ``refresh=True`` lists the files again (source tables here are
    read-only).  A scan made by another (e.g. stopped) session is never
    reused."""
    path = table_path(sf_dir, name)
    hit = None if refresh else _READS.get(path)
    if hit is not None and hit[0] is spark and spark.sparkContext._jsc is not None:
        df = hit[1]
    else:
        df = spark.read.parquet(path)
        _READS[path] = (spark, df)
    return df.select(*columns) if columns else df
