"""Session construction and the shared storage folder.

Checkpoints and intermediate tables go below the folder named by
``spark.checkpoint.dir``, which the cluster sets.  Only in local mode, where
driver and tasks share one machine, is a private temporary folder used when it
is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on.  AQE re-plans joins and coalesces small
# shuffle partitions at run time; skew-join splits a hot partition; UTC keeps
# date arithmetic identical to the oracle.  Broadcasts happen only with a
# proven size: explicitly after a row-count probe (``broadcast_if_small``) or
# by AQE from *measured* shuffle sizes (the adaptive threshold; without it AQE
# would fall back to the planner's, which is off) — never from a file-size
# estimate (a small compressed file can expand far beyond the threshold).
DEFAULT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "dimforge", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Return a folder below the cluster's shared checkpoint directory.

    The directory is read from the session (``spark.checkpoint.dir`` or a
    directory set with ``setCheckpointDir``).  Only when neither is set and
    Spark runs in local mode is a private temporary folder created and
    registered as the checkpoint directory; on a cluster that raises.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        base = sc.getConf().get("spark.checkpoint.dir", None)
        if not base:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="dimforge-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    elif "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path
