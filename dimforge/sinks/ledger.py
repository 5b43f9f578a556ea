"""Load ledger: which periods of which tables were loaded to the end.

An append-only Parquet table with one row per finished load: table, period,
rows written, version of the input, a number that grows with every load.  The
row is written after the data, so a load that fails in between shows as not
loaded, and running it again replaces its data and adds its row.  Checks are
joins on the ledger; nothing is concluded from exceptions or from files that
happen to lie in a folder.

Periods are stored as text (``str`` of the value); a table's last row per
period counts.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.sinks.publish import MissingPartition, path_exists, publish

SCHEMA = "table_name string, period string, rows long, input_version string, load_no long"


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    """All rows; none before the first load."""
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(ledger)


def loaded(spark: SparkSession, ledger: str, table: str) -> DataFrame:
    """``period, rows, input_version`` of the last load of each period."""
    last = (entries(spark, ledger).where(F.col("table_name") == table)
            .groupBy("period").agg(F.max_by(F.struct("rows", "input_version"), "load_no").alias("x")))
    return last.select("period", "x.rows", "x.input_version")


def record(spark: SparkSession, ledger: str, table: str, period, rows: int, input_version: str) -> None:
    """Append the row of a finished load."""
    row = [(table, str(period), rows, input_version, time.time_ns())]
    spark.createDataFrame(row, SCHEMA).coalesce(1).write.mode("append").parquet(ledger)


def load(df: DataFrame, ledger: str, table: str, path: str, column: str, period, *, input_version: str = "",
         partition_by: Sequence[str] | None = None, after=None) -> None:
    """Publish one period and record it.  ``after``: the period that must be
    loaded before it (depends-on-past)."""
    spark = df.sparkSession
    if after is not None:
        require_loaded(spark, ledger, table, after)
    publish(df, path, partition_by or [column], partition={column: period})
    rows = spark.read.schema(df.drop(column).schema).parquet(f"{path}/{column}={period}").count()    # from footers
    record(spark, ledger, table, period, rows, input_version)


def is_loaded(spark: SparkSession, ledger: str, table: str, period) -> bool:
    return not loaded(spark, ledger, table).where(F.col("period") == str(period)).isEmpty()


def require_loaded(spark: SparkSession, ledger: str, table: str, period) -> None:
    if not is_loaded(spark, ledger, table, period):
        raise MissingPartition(f"{table}: period {period} is not in the ledger")


def missing(spark: SparkSession, ledger: str, table: str, spine: DataFrame, column: str) -> DataFrame:
    """Periods of ``spine`` that were not loaded to the end."""
    have = loaded(spark, ledger, table).select("period")
    return spine.join(have, F.col(column).cast("string") == F.col("period"), "left_anti")


def outdated(spark: SparkSession, ledger: str, table: str, versions: DataFrame, column: str,
             version: str = "input_version") -> DataFrame:
    """Rows of ``versions`` (period and current input version) whose period was
    not loaded, or from another version of the input."""
    have = loaded(spark, ledger, table).select("period", F.col("input_version").alias("_loaded"))
    joined = versions.join(have, F.col(column).cast("string") == F.col("period"), "left")
    return joined.where(~F.col("_loaded").eqNullSafe(F.col(version))).select(*versions.columns)
