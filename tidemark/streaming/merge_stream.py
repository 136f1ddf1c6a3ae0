"""Structured Streaming: JSON feed files -> checked batches -> keyed state -> changes.

Two queries, each with Spark's own checkpoint and no log of ours:

1. *Judge.*  ``readStream.text`` picks up new files (oldest first, ``files_per_trigger``
   per batch).  ``foreachBatch`` parses a batch once, types it, and writes its last row
   per key to ``accepted/batch_id=N`` and its totals to ``judged/batch_id=N``; a replay
   overwrites both.  Keys are combined map-side here, so a hot key is one row further on.
   A batch that cannot be stored raises before it is checkpointed and is read again after
   a restart; with ``quarantine`` its lines go to that folder and the stream goes on.  A
   batch without records is EMPTY and passes.
2. *Merge.*  A file stream over the accepted rows, grouped by key, with the key's current
   row as keyed state in Spark's state store (RocksDB).  Each accepted row is classified
   against the state and appended to ``changes`` by Spark's exactly-once file sink:
   batch, action, the row as it stands afterwards.  The state knows the last batch it took,
   so a batch that comes twice changes nothing.

Cost per batch follows the batch, not the table: no snapshot is rewritten.  The current
rows are the last change of each key (:meth:`MergeStream.current`); counts per batch are
sums over ``changes``.  State is held as text, which keeps every stored type exact on its way
through pandas.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState

from tidemark.operators import merge as M
from tidemark.operators.merge import MergeInput
from tidemark.operators.normalize import conform, qcol, record_vocabulary, resolve_columns
from tidemark.operators.quality import has_null_key, pk_missing
from tidemark.plans.ingest import staged
from tidemark.session import hadoop_path, scratch
from tidemark.sources.feeds import parse_lines
from tidemark.spec import FLAG_DELETE, STATUS_EMPTY, STATUS_FAILED, STATUS_SUCCESS, STATUS_VALIDATION_FAILED, UPSERT_FLAGS, TableSpec

_JUDGED = "status string, rows_received long, rows_malformed long, error_message string, feed_name string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Batch number of rows that were there before the stream began.
BEFORE = -1


class BatchFailed(RuntimeError):
    """A micro-batch could not be applied; nothing of it was."""


def _as_text(name: str, dtype: T.DataType) -> Column:
    c = qcol(name)
    return (c + F.lit(0.0) if isinstance(dtype, (T.DoubleType, T.FloatType)) else c).cast("string")  # -0.0 is 0.0


def _reader(dtype: T.DataType) -> Callable[[str], object]:
    """How to compare two values given as text."""
    if isinstance(dtype, T.IntegralType):
        return int
    return Decimal if isinstance(dtype, T.DecimalType) else float if isinstance(dtype, T.FractionalType) else str


def _fold(spec: TableSpec, newer_than: str | None) -> Callable:
    """The state function: accepted rows of one key, in batch order -> changes."""
    cols = [c for c in spec.columns if c not in spec.pk]
    version = None if newer_than is None else (cols.index(newer_than), _reader(spec.dtype(newer_than)))

    def older(row: list, held: list) -> bool:
        at, read = version
        return row[at] is not None and held[at] is not None and read(row[at]) < read(held[at])

    def work(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held = (state.get[0], None if state.get[1] is None else list(state.get[1])) if state.exists else (BEFORE - 1, None)
        incoming = sorted(((int(b), flag, list(values), set(present)) for f in frames
                           for b, flag, values, present in zip(f["batch_id"], f["_flag"], f["_values"], f["_present"])), key=lambda r: r[0])
        out = []
        for batch, flag, values, present in incoming:
            if batch <= last:
                continue                              # a batch that was read again
            last, row = batch, held
            if held is not None and version is not None and older(values, held):
                action = "stale"
            elif flag == FLAG_DELETE:
                action, held = ("no_match", None) if held is None else ("delete", None)
            elif flag in UPSERT_FLAGS:
                row = [v if c in present else None if held is None else o for c, v, o in zip(cols, values, held or values)]
                action = "insert" if held is None else "unchanged" if row == held else "update"
                held = row
            else:
                action = "ignored"
            out.append((batch, action, row))
        state.update((last, held))
        if out:
            yield pd.DataFrame({**{k: [str(v)] * len(out) for k, v in zip(spec.pk, key)}, "batch_id": [o[0] for o in out],
                                "action": [o[1] for o in out], "_row": [o[2] for o in out]})

    return work


class MergeStream:
    """One feed streamed into one table under ``root``."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, order_col: str | None = None,
                 newer_than: str | None = None, feed_name: str | None = None):
        """``order_col``: the feed's own order of arrival; without it, the line's place
        (file, split offset, row).  ``newer_than``: a stored version column; a row with a lower
        value than the stored one is ``stale``."""
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec
        self.order_col, self.newer_than, self.feed_name = order_col, newer_than, feed_name or spec.name

    def _has(self, folder: str) -> bool:
        fs, at = hadoop_path(self.spark, f"{self.root}/{folder}")
        return fs.exists(at)

    # ------------------------------------------------------------------ judge
    def _accept(self, won: DataFrame, present: list[str], batch_id: int) -> None:
        types = {f.name: f.dataType for f in self.spec.schema.fields}
        values = [(_as_text(c, types[c]) if c in won.columns else F.lit(None).cast("string")) for c in self.spec.columns if c not in self.spec.pk]
        written = [c for c in self.spec.columns if c in present or (c == "flag")]
        (won.select(*[_as_text(k, types[k]).alias(k) for k in self.spec.pk], F.col("flag").alias("_flag"), F.array(*values).alias("_values"),
                    F.lit(written).cast("array<string>").alias("_present"))
            .write.mode("overwrite").parquet(f"{self.root}/accepted/batch_id={batch_id}"))

    def start_from(self, rows: DataFrame) -> None:
        """Rows of the table before the stream's first batch (unique keys)."""
        if self._has("accepted"):
            raise ValueError(f"{self.root}: the stream has begun")
        flagged = rows if "flag" in rows.columns else rows.withColumn("flag", F.lit(UPSERT_FLAGS[0]))
        self._accept(flagged, self.spec.columns, BEFORE)

    def _judge(self, batch: DataFrame, batch_id: int) -> dict:
        """Check a batch and write its winners; returns its totals."""
        out = {"status": STATUS_SUCCESS, "rows_received": 0, "rows_malformed": 0, "error_message": None}
        lines = batch.select("value", F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"),
                                               F.monotonically_increasing_id().alias("row")).alias("pos"))
        with scratch(self.spark, "batch") as records_at, scratch(self.spark, "winners") as winners_at:
            records, counts = staged(parse_lines(lines), batch.sparkSession, records_at)
            out |= {"rows_received": int(counts["records"] or 0), "rows_malformed": int(counts["malformed"] or 0)}
            if not counts["records"]:
                return out | {"status": STATUS_EMPTY}
            vocabulary, index = record_vocabulary(records, self.spec)
            plan = resolve_columns(vocabulary, self.spec)
            missing = pk_missing(self.spec, plan.resolved)
            if missing:
                return out | {"status": STATUS_VALIDATION_FAILED, "error_message": f"{self.spec.name}: missing PK columns: {missing}"}
            typed = conform(records, self.spec, plan, rec="rec", pos="pos", key_index=index)
            if self.order_col is not None:
                typed = typed.withColumn("pos", F.col(self.order_col))
            won = M.counted_winners(MergeInput(typed, self.spec, plan.present))
            won.write.parquet(winners_at)
            won = self.spark.read.schema(won.schema).parquet(winners_at)
            bad = won.agg(F.sum("_nbad")).first()[0]
            if bad:
                return out | {"status": STATUS_FAILED, "error_message": f"{bad} rows hold values the declared types cannot store"}
            self._accept(won.where(~has_null_key(list(self.spec.pk))), plan.present, batch_id)
        return out

    # -------------------------------------------------------------------- run
    def run(self, source_dir: str, files_per_trigger: int = 1, quarantine: str | None = None) -> None:
        """Take the files present now (availableNow), from where the last run ended."""
        lines = (self.spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(source_dir)
                 .select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")))

        def per_batch(batch: DataFrame, batch_id: int) -> None:
            res = self._judge(batch, batch_id)
            (self.spark.createDataFrame([{**res, "feed_name": self.feed_name}], _JUDGED).write.mode("overwrite")
                 .parquet(f"{self.root}/judged/batch_id={batch_id}"))
            if res["status"] not in (STATUS_SUCCESS, STATUS_EMPTY):
                if quarantine is None:
                    raise BatchFailed(f"batch {batch_id}: {res['status']}: {res['error_message']}")
                batch.select("value", F.col("_file").alias("file")).write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")

        try:
            self._until_done(lines.writeStream.foreachBatch(per_batch), "judge")
        finally:
            if self._has("accepted"):             # batches before a failed one are applied
                self._merge()

    def _merge(self) -> None:
        accepted = T.StructType([T.StructField(k, T.StringType()) for k in self.spec.pk] + [
            T.StructField("_flag", T.StringType()), T.StructField("_values", T.ArrayType(T.StringType())),
            T.StructField("_present", T.ArrayType(T.StringType())), T.StructField("batch_id", T.LongType())])
        made = T.StructType([T.StructField(k, T.StringType()) for k in self.spec.pk] + [
            T.StructField("batch_id", T.LongType()), T.StructField("action", T.StringType()), T.StructField("_row", T.ArrayType(T.StringType()))])
        changes = (self.spark.readStream.schema(accepted).parquet(f"{self.root}/accepted").groupBy(*[qcol(k) for k in self.spec.pk])
                   .applyInPandasWithState(_fold(self.spec, self.newer_than), made, "last long, held array<string>", "append", "NoTimeout"))
        self._until_done(changes.writeStream.format("parquet").outputMode("append").option("path", f"{self.root}/changes"), "merge")

    def _until_done(self, writer, name: str) -> None:
        with _conf(self.spark, _PROVIDER, _ROCKSDB):
            query = writer.option("checkpointLocation", f"{self.root}/_checkpoint/{name}").trigger(availableNow=True).start()
        query.awaitTermination()

    # ------------------------------------------------------------------- read
    def changes(self) -> DataFrame:
        """Key, the other columns as they stand after the row, action, batch_id."""
        rest = [c for c in self.spec.columns if c not in self.spec.pk]
        schema = T.StructType([*self.spec.schema.fields, T.StructField("action", T.StringType()), T.StructField("batch_id", T.LongType())])
        if not self._has("changes"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.parquet(f"{self.root}/changes")
        values = {**{k: qcol(k) for k in self.spec.pk}, **{c: F.col("_row").getItem(i) for i, c in enumerate(rest)}}
        return rows.select(*[values[c].cast(self.spec.dtype(c)).alias(c) for c in self.spec.columns], "action", "batch_id")

    def current(self) -> DataFrame:
        """The table's rows now: the last change of each key that is not deleted."""
        keys, rest = list(self.spec.pk), [c for c in self.spec.columns if c not in self.spec.pk]
        made = self.changes().where(F.col("action").isin("insert", "update", "delete"))
        last = made.groupBy(*[qcol(k) for k in keys]).agg(F.max_by(F.struct("action", *[qcol(c) for c in rest]), "batch_id").alias("_w"))
        return last.where("_w.action <> 'delete'").select(*[qcol(c) if c in keys else F.col("_w").getField(c).alias(c) for c in self.spec.columns])

    def log(self) -> DataFrame:
        """One row per batch: status, rows received, inserted, updated, deleted, unchanged,
        rejected and malformed, error."""
        counts = self.changes().groupBy("batch_id").agg(*M.count_columns(F.col("action")))
        judged = self.spark.read.schema(f"{_JUDGED}, batch_id long").parquet(f"{self.root}/judged")
        n = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(f"rows_{c}")
        rows = judged.join(counts, "batch_id", "left").select("batch_id", "feed_name", "status", "rows_received", "rows_malformed",
                                                              *[n(c) for c in ("inserted", "updated", "deleted", "unchanged", "stale")], "error_message")
        done = F.col("rows_inserted") + F.col("rows_updated") + F.col("rows_deleted")
        return rows.select("*", done.alias("processed_rows"), (F.col("rows_received") - done - F.col("rows_unchanged")).alias("rows_rejected"))


@contextmanager
def _conf(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)
