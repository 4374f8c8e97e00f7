"""Session construction and the shared scratch folder."""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Anything else (executors, memory, shuffle
# partitions) belongs to the cluster and is left alone.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "posttrend", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Create a UTC session; ``conf`` wins over the base settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is made, which is only right
    in local mode, so any other master is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="posttrend-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return posixpath.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df):
    """Reliable checkpoint of ``df``, so that lost executors do not replay its whole history."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()
