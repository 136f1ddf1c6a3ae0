"""Table snapshots: plain Parquet folders and one small pointer file.

Layout under ``root``::

    versions/00000007-<id>/part-….parquet    a version: whole rows, written by Spark
    current.json                              names the current version's folder

A write makes a new folder and then publishes it: the pointer is written under another
name, closed, and renamed over the old one.  A writer that dies before the rename leaves a
folder that nobody reads.  The first thing ever written is a pointer to version 0, which
has no rows; so a table without a pointer is new only while it has no ``versions``
folder, and anything else (no pointer beside versions, an empty or a cut pointer) is
:class:`BrokenSnapshot`, never an empty table.

One writer at a time is assumed.  A version that was built on another than the current
one is not published (:class:`Conflict`), which catches most accidents but is no lock;
for concurrent writers, history and clean-up, use the table format of the cluster.  The
version before the current one stays, so that running readers finish; older ones go.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.normalize import qcol
from tidemark.session import hadoop_path
from tidemark.spec import TableSpec

POINTER = "current.json"


class Conflict(RuntimeError):
    """Another writer published a version in the meantime."""


class BrokenSnapshot(RuntimeError):
    """The pointer of a table that has versions cannot be read."""


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec
        self._fs, self._root = hadoop_path(spark, self.root)

    def _path(self, rel: str):
        return hadoop_path(self.spark, f"{self.root}/{rel}")[1]

    # ---------------------------------------------------------------- pointer
    def _pointer(self) -> dict | None:
        """What the pointer says; None for a table that was never written."""
        if not self._fs.exists(self._path(POINTER)):
            if self._fs.exists(self._path("versions")):
                raise BrokenSnapshot(f"{self.root}: there are versions, but no {POINTER}")
            return None
        stream = self._fs.open(self._path(POINTER))
        try:
            text = bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()
        try:
            info = json.loads(text)
            return {"version": info["version"], "folder": info["folder"], "before": info["before"], "extra": info.get("extra")}
        except (ValueError, KeyError, TypeError) as e:
            raise BrokenSnapshot(f"{self.root}/{POINTER} cannot be read: {e}") from e

    def _point(self, info: dict) -> None:
        """Replace the pointer in one step."""
        jvm, other = self.spark.sparkContext._jvm, self._path(f"_{uuid.uuid4().hex}.json")
        out = self._fs.create(other, False)
        try:
            out.write(bytearray(json.dumps(info, default=str).encode("utf-8")))
        finally:
            out.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        over = self.spark.sparkContext._gateway.new_array(rename, 1)
        over[0] = rename.OVERWRITE
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._root.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        files.rename(self._fs.makeQualified(other), self._fs.makeQualified(self._path(POINTER)), over)

    def current_version(self) -> int | None:
        """Number of the current version; None when nothing was published yet."""
        info = self._pointer()
        return info["version"] or None if info else None

    def extra(self) -> dict | None:
        """What was published with the current version (its counts)."""
        info = self._pointer()
        return info["extra"] if info else None

    # ------------------------------------------------------------------- rows
    def read(self) -> DataFrame:
        """The current version; an empty frame of the spec's schema when nothing was
        published yet."""
        info = self._pointer()
        if not info or not info["folder"]:
            return self.spark.createDataFrame([], self.spec.schema)
        return self.spark.read.schema(self.spec.schema).parquet(f"{self.root}/versions/{info['folder']}")

    def stage(self, df: DataFrame) -> str:
        """Write whole rows (unique keys) to a folder of their own, without publishing
        it; :meth:`publish` or :meth:`discard` it."""
        info = self._pointer()
        if info is None:
            info = {"version": 0, "folder": None, "before": None}
            self._point(info)
        folder = f"{info['version'] + 1:08d}-{uuid.uuid4().hex}"
        # as many files as the data needs, whatever the number of tasks that made the rows
        rows = df.select(*[qcol(c) for c in self.spec.columns]).hint("rebalance")
        rows.write.parquet(f"{self.root}/versions/{folder}")
        return folder

    def publish(self, folder: str, previous: int | None, extra: dict | None = None) -> int:
        """Make a staged folder the version after ``previous``."""
        info = self._pointer()
        if info is None or info["version"] != (previous or 0):
            self.discard(folder)
            raise Conflict(f"{self.spec.name}: version {info and info['version']} was published during the write")
        self._point({"version": info["version"] + 1, "folder": folder, "before": info["folder"], "extra": extra})
        if info["before"]:
            self.discard(info["before"])
        return info["version"] + 1

    def write(self, df: DataFrame, extra: dict | None = None) -> int:
        """Publish ``df`` (whole rows, unique keys) as the next version."""
        previous = self.current_version()
        return self.publish(self.stage(df), previous, extra)

    def discard(self, folder: str) -> None:
        self._fs.delete(self._path(f"versions/{folder}"), True)
