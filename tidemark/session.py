"""Session helpers: builder defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def builder(master: str | None = None, shuffle_partitions: int = 8, app: str = "tidemark"):
    """Session defaults for local runs and tests.  On a cluster, pass the
    cluster's own settings; nothing here is required by the library.

    The method limit is worth taking over: feeds are parsed and converted by wide
    projections, and the JVM does not compile methods above 8000 bytes of code, so
    above that Spark had better generate them in pieces."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    return (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.driver.memory", "8g")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.codegen.hugeMethodLimit", "8000")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none (local tests) is a private temporary folder
    created and registered.  Lineage is cut by writing there, never with a
    machine-local checkpoint.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(conf)
    return (sc.getCheckpointDir() or conf).rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path and the path in it, as Hadoop objects."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files under a folder."""
    fs, at = hadoop_path(spark, path)
    return int(fs.getContentSummary(at).getLength())


def broadcast_threshold(spark: SparkSession) -> int:
    """Bytes up to which Spark broadcasts a side of a join; -1: never."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return -1 if text.startswith("-") else int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/tidemark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint root, in the application's own folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession, name: str):
    """A fresh folder name; what was written there is deleted at the end."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        fs, at = hadoop_path(spark, path)
        fs.delete(at, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application has in scratch.  Frames that operators returned
    may read it, so call this when their rows are written."""
    fs, at = hadoop_path(spark, _scratch_root(spark))
    fs.delete(at, True)
