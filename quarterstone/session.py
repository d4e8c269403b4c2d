"""Session settings and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster deployment starts from. Executor counts and sizes, and the
# number of shuffle partitions before AQE coalesces them, belong to the cluster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # reports are built from many small expressions; recording a call site for each of
    # them takes longer than planning the query
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "quarterstone", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, reachable by every executor.

    Only where the setting is missing (single-machine tests) a temporary folder is
    chosen and stored in the session, so that later calls agree on it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="quarterstone-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/quarterstone/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the shared folder and read back."""
    path = shared_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
