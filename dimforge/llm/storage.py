"""Writing intermediate tables and binary files to the cluster's shared folder.

Everything goes below ``spark.checkpoint.dir`` (see
:func:`dimforge.session.shared_dir`), so that any executor can read it and a
lost executor loses nothing.  Folder names are unique per call: a retried or
concurrent run never reads another run's files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from dimforge.session import shared_dir


def scratch(spark, name: str) -> str:
    """A new, unique folder URI below the shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, file_rows: int = 0, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the
    lineage, computes once, and survives the loss of executors.  ``file_rows``
    bounds the rows of a file (for rows of megabytes)."""
    path = scratch(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", file_rows).option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bytes(folder: str, name: str, data: bytes) -> str:
    """Write one file from inside a task and return its URI.

    The name gets a unique suffix, so two attempts of one task never write
    the same file; the caller's manifest (written through Spark's commit
    protocol) decides which attempt counts.
    """
    from pyarrow import fs

    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path, recursive=True)
    leaf = f"{name}-{uuid.uuid4().hex[:8]}"
    with store.open_output_stream(f"{path}/{leaf}") as out:
        out.write(data)
    return f"{folder}/{leaf}"


# What a Python worker remembers between tasks of one operator.
REMEMBERED: list[dict] = []


def forget() -> None:
    """Called by tasks of other operators: their worker gives that memory
    back."""
    for cache in REMEMBERED:
        cache.clear()


def release() -> None:
    """Give unused memory of this worker back to the machine: workers are kept
    for the next tasks, and neither Arrow nor the C heap shrinks by itself."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):            # not glibc
        pass


def tidy(task):
    """A task over batches whose worker ends it with :func:`release`."""
    def run(batches):
        try:
            yield from task(batches)
        finally:
            release()

    return run


def ship_package(spark) -> None:
    """Make this package importable in the Python workers (once per session),
    as ``spark-submit --py-files`` would."""
    import shutil
    import tempfile
    from pathlib import Path

    sc = spark.sparkContext
    if getattr(sc, "_dimforge_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = tempfile.mkdtemp(prefix="dimforge-code-")
    shutil.copytree(package, f"{target}/src/{package.name}", ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(f"{target}/{package.name}", "zip", f"{target}/src"))
    sc._dimforge_shipped = True
