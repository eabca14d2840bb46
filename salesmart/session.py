"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans rely on.
# * Broadcasts are size-checked twice.  At planning time a side is broadcast
#   only if its estimate is under 10 MB, where a file's estimate is ten times
#   its size on disk (a compressed file decodes to several times its size).
#   At run time AQE turns a sort-merge join into a broadcast only after the
#   side's shuffle has run and its measured size is under 32 MB.  Anything
#   larger stays a sort-merge join.
# * AQE splits skewed shuffle partitions of the fact side of a join (one
#   customer or product holding a large share of the orders) and coalesces
#   small partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.sources.fileCompressionFactor": "10",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "salesmart", extra: dict | None = None) -> SparkSession:
    """A session with the library's settings; without ``master`` the one that spark-submit or the configuration names."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from the session (``spark.checkpoint.dir`` or a folder already set
    on the context).  Only a local master, whose tasks share the driver's disk,
    gets a folder of its own if neither exists; any other raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote session has no context; read the setting only
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            raise RuntimeError("spark.checkpoint.dir is not set on this session")
        return base
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="salesmart-ckpt-")
        sc.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    leaf = name or "run"
    return os.path.join(checkpoint_root(spark), f"{leaf}-{uuid.uuid4().hex[:12]}")


def drop_shared(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder made by ``shared_dir``, in whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
