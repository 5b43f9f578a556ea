"""Idempotent publishing of partitioned tables and input-completeness checks.

``publish`` replaces the partitions present in the DataFrame (dynamic
partition overwrite), one named partition (``partition={column: value}``: also
when the load has no rows), or the whole table (``replace_all``).  Running a
load twice leaves the table as if it ran once; other partitions — including
the one a cumulative step just read — are untouched.  Columns are matched to
the table spec *by name* (never by position, also inside structs); NOT NULL
columns are asserted inside the written plan, since Parquet does not enforce
them.

``load_periods`` is the depends-on-past driver for incremental loads: one
Spark job per period, each reading the stored previous partition (so the
lineage never grows), refusing to run when that partition is missing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingPartition(RuntimeError):
    pass


def table_location(spark: SparkSession, *parts: str) -> str:
    """A table folder below the warehouse, where a later session finds it (the
    checkpoint folder is new in every session)."""
    return "/".join([spark.conf.get("spark.sql.warehouse.dir").rstrip("/"), "dimforge", *parts])


def _conform_type(col, have: T.DataType, want: T.DataType):
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        names = {f.name: f.dataType for f in have.fields}
        missing = [f.name for f in want.fields if f.name not in names]
        if missing:
            raise ValueError(f"struct fields missing: {missing}")
        return F.struct(*[_conform_type(col[f.name], names[f.name], f.dataType).alias(f.name)
                          for f in want.fields])
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType) \
            and isinstance(want.elementType, T.StructType):
        return F.transform(col, lambda x: _conform_type(x, have.elementType, want.elementType))
    return col if have == want else col.cast(want)


def conform(df: DataFrame, spec: T.StructType) -> DataFrame:
    """Select and cast the spec's columns by name (struct fields too)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in spec.fields if f.name not in have]
    if missing:
        raise ValueError(f"columns missing for the table spec: {missing}")
    return df.select(*[_conform_type(F.col(f.name), have[f.name], f.dataType).alias(f.name)
                       for f in spec.fields])


def assert_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with NOT NULL columns that raise while they are written."""
    return df.withColumns({c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL in NOT NULL column {c}"))
                                     .cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in columns})


def _owned(df: DataFrame, partition: dict) -> DataFrame:
    """``df`` without the partition columns; a row with another value of them
    raises while it is written."""
    foreign = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.lit(v).cast(df.schema[c].dataType)) for c, v in partition.items()])
    message = F.concat(F.lit(f"row outside the partition {partition}: "),
                       F.to_json(F.struct(*[F.col(c) for c in partition])))
    rest = [c for c in df.columns if c not in partition]
    guarded = [F.when(foreign, F.raise_error(message).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c) for c in rest]
    return df.select(*guarded)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of its file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)


def publish(df: DataFrame, path: str, partition_by: Sequence[str], spec: T.StructType | None = None,
            not_null: Sequence[str] = (), sort_within: Sequence[str] = (), partition: dict | None = None,
            replace_all: bool = False) -> None:
    """Write ``df`` replacing only the partitions it contains.

    ``partition``: the values of the leading partition column(s) that this
    load owns; that folder is replaced as a whole, so rows of an earlier run
    go even when this one has none.  A row of another partition raises while
    it is written.  ``replace_all`` replaces the table.

    Rows are dealt by partition before the write (AQE splits large ones and
    joins small ones), so a partition gets few files.  ``sort_within`` orders
    rows inside each written file, so Parquet row-group statistics let later
    filters on those columns skip row groups — e.g. an SCD2 snapshot sorted by
    its end period lets the next increment read open and other runs apart."""
    if spec is not None:
        df = conform(df, spec)
    df = assert_not_null(df, not_null)
    inner = [c for c in partition_by if c not in (partition or {})]
    if partition:
        df = _owned(df, partition)
        path = "/".join([path, *[f"{c}={v}" for c, v in partition.items()]])
    if inner:
        df = df.hint("rebalance", *inner)
    if sort_within:
        df = df.sortWithinPartitions(*inner, *sort_within)
    mode = "static" if partition or replace_all else "dynamic"
    w = df.write.mode("overwrite").option("partitionOverwriteMode", mode)
    (w.partitionBy(*inner) if inner else w).parquet(path)


def publish_table(df: DataFrame, name: str, partition_by: Sequence[str],
                  bucket_by: tuple[int, Sequence[str]] | None = None, spec: T.StructType | None = None,
                  not_null: Sequence[str] = ()) -> None:
    """Publish into a catalog table, replacing only the partitions present.

    With ``bucket_by=(n, keys)`` the table is bucketed on the entity key: the
    next incremental load joins its previous snapshot (the largest input)
    without shuffling it — only the new period is shuffled into the ``n``
    buckets (choose ``n`` >= ``spark.sql.shuffle.partitions``).  Later loads
    insert by name into the existing layout."""
    spark = df.sparkSession
    if spec is not None:
        df = conform(df, spec)
    df = assert_not_null(df, not_null)
    if not spark.catalog.tableExists(name):
        w = df.write.format("parquet").mode("overwrite").partitionBy(*partition_by)
        if bucket_by:
            w = w.bucketBy(bucket_by[0], *bucket_by[1])
        w.saveAsTable(name)
        return
    cols = spark.table(name).columns                     # insertInto is positional: order by name first
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for table {name}: {missing}")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.select(*cols).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def read_table_partition(spark: SparkSession, name: str, column: str, value) -> DataFrame:
    """One partition of a catalog table (bucketing, if any, is kept)."""
    return spark.table(name).where(F.col(column) == F.lit(value))


def read_partition(spark: SparkSession, path: str, column: str, value, spec: T.StructType | None = None) -> DataFrame:
    """One partition of a published table: only its folder is listed and
    read.  ``spec`` gives the declared types (a text partition value would
    otherwise be read by its looks).  A value given as an expression is a
    partition filter on the whole table."""
    if isinstance(value, Column):
        return spark.read.parquet(path).where(F.col(column) == value)
    reader = spark.read.option("basePath", path)
    return (reader.schema(spec) if spec is not None else reader).parquet(f"{path}/{column}={value}")


def has_partition(spark: SparkSession, path: str, column: str, value) -> bool:
    """Whether the partition was loaded (an empty one counts).  Whether its
    load also came to its end is known to the ledger (``sinks.ledger``)."""
    if isinstance(value, Column):
        return path_exists(spark, path) and not read_partition(spark, path, column, value).isEmpty()
    return path_exists(spark, f"{path}/{column}={value}")


def require_previous(spark: SparkSession, path: str, column: str, value) -> None:
    """depends_on_past: refuse to build period t without period t-1."""
    if not has_partition(spark, path, column, value):
        raise MissingPartition(f"{path}: partition {column}={value} is missing")


def load_periods(spark: SparkSession, path: str, column: str, periods: Sequence,
                 step: Callable[[DataFrame | None, object], DataFrame],
                 partition_by: Sequence[str] | None = None, past=None) -> None:
    """Run ``step(previous_partition_or_None, period)`` for each period in
    order and publish its result as that period's partition; the previous
    partition is always read back from storage.  ``past``: the stored period
    before the first one (None: the table starts here)."""
    for previous, p in zip([past, *periods], periods):
        prev = None
        if previous is not None:
            require_previous(spark, path, column, previous)
            prev = read_partition(spark, path, column, previous)
        publish(step(prev, p), path, partition_by or [column], partition={column: p})


def missing_periods(available: DataFrame, column: str, spine: DataFrame) -> DataFrame:
    """Periods of ``spine`` (same column name) with no row in ``available``
    — a full set of partition sensors as a query.  Both sides are distinct
    periods (bounded by the calendar), so the anti-join is cheap."""
    have = available.select(column).distinct()
    return spine.join(have, column, "left_anti")
