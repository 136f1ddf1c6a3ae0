"""Feed -> merge input -> snapshot version -> run log."""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field, replace
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.operators import merge as M
from tidemark.operators import runlog as RL
from tidemark.operators.merge import MergeInput
from tidemark.operators.normalize import ColumnPlan, conform, qcol, record_vocabulary, resolve_columns
from tidemark.operators.quality import findings, has_null_key, pk_missing
from tidemark.session import broadcast_threshold, scratch, scratch_path, stored_bytes
from tidemark.sources.store import Conflict
from tidemark.spec import (API_ERROR_CODES, BUSINESS_DAY_CUTOFF_HOUR, DEFAULT_TIMEZONE, NO_CONTENT_CODE,
                           RUN_LOG_RETENTION_DAYS, STATUS_API_ERROR, STATUS_EMPTY, STATUS_FAILED, STATUS_NO_CONTENT,
                           STATUS_STARTED, STATUS_SUCCESS, STATUS_TABLE_NOT_FOUND, STATUS_VALIDATION_FAILED, TableSpec)

def frame_input(df: DataFrame, spec: TableSpec, order: str, on_fraction: str = "fail",
                require_flag: bool = False) -> tuple[MergeInput, ColumnPlan]:
    """An already-parsed DataFrame (columns = vendor names) plus its arrival-order
    column -> conformed merge input."""
    raw = [c for c in df.columns if c != order]
    plan = resolve_columns(raw, spec)
    typed = conform(df.withColumnRenamed(order, "pos") if order != "pos" else df, spec, plan,
                    pos="pos", on_fraction=on_fraction, require_flag=require_flag)
    return MergeInput(typed, spec, plan.present), plan


def records_input(records: DataFrame, spec: TableSpec, on_fraction: str = "fail",
                  require_flag: bool = False, vocabulary: list[str] | None = None) -> tuple[MergeInput, ColumnPlan]:
    """Parsed records (pos, rec map) -> conformed merge input.  The raw names of the
    target's columns come from one small aggregate unless given; pass stored records
    (:func:`staged`) so that their text is parsed once."""
    index = {k: i for i, k in enumerate(vocabulary)} if vocabulary is not None else None
    if vocabulary is None:
        vocabulary, index = record_vocabulary(records, spec)
    plan = resolve_columns(vocabulary, spec)
    typed = conform(records, spec, plan, rec="rec", pos="pos", on_fraction=on_fraction,
                    require_flag=require_flag, key_index=index)
    return MergeInput(typed, spec, plan.present), plan


def staged(feed, spark: SparkSession, path: str | None = None) -> tuple[DataFrame, dict]:
    """The records of a parsed feed, written to shared scratch (or ``path``) in the one
    pass that parses its text, and the counts of its lines (lines, skipped, malformed,
    status_messages, records)."""
    obs = Observation(f"lines_{uuid.uuid4().hex}")
    path = path or scratch_path(spark, "records")
    records = feed.observed(obs)
    records.write.parquet(path)
    return spark.read.schema(records.schema).parquet(path), obs.get


# --------------------------------------------------------------------------- end to end


@dataclass
class IngestResult:
    status: str
    received: int = 0
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    unchanged: int = 0
    stale: int = 0
    version: int | None = None
    error: str | None = None
    warnings: list[str] = field(default_factory=list)
    malformed: int = 0

    @property
    def processed(self) -> int:
        return self.inserted + self.updated + self.deleted

    @property
    def rejected(self) -> int:
        """Received rows that changed nothing and were not found unchanged: NULL keys,
        in-feed duplicates, deletes of absent keys, unknown flags."""
        return self.received - (self.inserted + self.updated + self.deleted + self.unchanged)

    def as_row(self) -> dict:
        return {"status": self.status, "rows_received": self.received, "rows_inserted": self.inserted,
                "rows_updated": self.updated, "rows_deleted": self.deleted, "rows_unchanged": self.unchanged,
                "rows_rejected": self.rejected, "processed_rows": self.processed, "version": self.version,
                "error_message": self.error}


def apply_feed(mi: MergeInput, store, mode: str = "api", change_test: bool = True,
               newer_than: str | None = None, fail_on_violation: bool = True,
               ignore_unknown_flags_first: bool = False) -> IngestResult:
    """Apply a conformed feed to a snapshot store as one all-or-nothing version.

    First the feed alone: its last row per key goes to shared scratch, with the feed's
    counts observed in that job; a feed that is empty or breaks a rule ends here, and
    the target is not read.  Then the winners meet the target, see :func:`publish`."""
    missing = pk_missing(mi.spec, mi.feed.columns)
    if missing:
        return IngestResult(STATUS_VALIDATION_FAILED, error=f"{mi.spec.name}: missing PK columns: {missing}")
    spark = mi.feed.sparkSession
    won = M.bulk_winners(mi, True) if mode == "bulk" else M.counted_winners(mi, ignore_unknown_flags_first)
    seen = Observation(f"feed_{uuid.uuid4().hex}")
    with scratch(spark, "winners") as path:
        won.observe(seen, *M.winner_totals(mi.keys)).write.parquet(path)
        m = {k: int(v or 0) for k, v in seen.get.items()}
        res = IngestResult(STATUS_SUCCESS, received=m["received"])
        if m["received"] == 0:
            res.status = STATUS_EMPTY
        elif m["bad_rows"] and fail_on_violation:
            res.status, res.error = STATUS_FAILED, f"{m['bad_rows']} rows hold values the declared types cannot store"
        elif mode == "bulk" and m["null_key_upserts"]:
            res.status, res.error = STATUS_FAILED, f"NULL primary key in {m['null_key_upserts']} add/update rows"
        if res.status != STATUS_SUCCESS:
            return res
        rows = spark.read.schema(won.schema).parquet(path).where(~has_null_key(mi.keys))
        return publish(rows, stored_bytes(spark, path), store, mi, res, mode == "bulk", change_test, newer_than)


def publish(won: DataFrame, size: int, store, mi: MergeInput, res: IngestResult, bulk: bool = False, change_test: bool = True,
            newer_than: str | None = None) -> IngestResult:
    """Merge winners into the current version and publish the outcome.

    A feed that Spark would broadcast (``size`` bytes) meets the target in two broadcast
    joins: the rows its keys hit are classified and stored, the others are passed on by an
    anti join; the target is not shuffled, and a feed that changes nothing writes no
    version.  A larger feed takes one full outer join, one shuffle of both sides."""
    spark, keys, previous = won.sparkSession, mi.keys, store.current_version()
    target, obs = store.read(), Observation(f"merge_{uuid.uuid4().hex}")
    counts = [*M.count_columns(F.col("_action")), F.count_if(F.col("_action") == "reinsert").alias("reinserted")]

    def counted() -> None:
        n = {k: int(v or 0) for k, v in obs.get.items()}
        res.inserted, res.updated, res.deleted = n["inserted"] + n["reinserted"], n["updated"], n["deleted"]
        res.unchanged, res.stale = n["unchanged"], n["stale"]

    def classified(rows: DataFrame, how: str) -> DataFrame:
        found = M.classify(rows, won, mi, change_test, bulk=bulk, newer_than=newer_than, how=how)
        return M.next_state(found.observe(obs, *counts), mi)

    only_keys = won.select(*[qcol(k) for k in keys])
    if size <= broadcast_threshold(spark):
        with scratch(spark, "touched") as path:
            touched = classified(target.join(only_keys, keys, "left_semi"), "right_outer")
            touched.write.parquet(path)
            counted()
            if res.processed == 0 and previous is not None:
                res.version = previous                # nothing changed: the current version stays
                return res
            rest = target.join(only_keys, keys, "left_anti").select(*touched.columns)
            folder = store.stage(rest.unionByName(spark.read.schema(touched.schema).parquet(path)))
    else:
        folder = store.stage(classified(target, "full_outer"))
        counted()
        if res.processed == 0 and previous is not None:
            store.discard(folder)
            res.version = previous
            return res
    try:
        res.version = store.publish(folder, previous, {"counts": res.as_row()})
    except Conflict as e:
        return replace(res, status=STATUS_FAILED, inserted=0, updated=0, deleted=0, unchanged=0, stale=0, error=str(e))
    return res


# --------------------------------------------------------------------------- run log


RUN_EVENT_SCHEMA = ("id long, feed_name string, requested_date date, status string, http_status int, "
                    "rows_received long, processed_rows long, rows_inserted long, rows_updated long, "
                    "rows_deleted long, rows_unchanged long, rows_rejected long, rows_malformed long, warnings string, "
                    "error_message string, started_at timestamp_ntz, finished_at timestamp_ntz, "
                    "event_at timestamp_ntz, seq int, started_on date")
REJECTED_KEY_SCHEMA = "id long, key string"
_EVENT_COLS = [c.split()[0] for c in RUN_EVENT_SCHEMA.split(", ")]
EXPIRED = "EXPIRED"


class RunLog:
    """Append-only run events under ``root/events`` (Parquet, by start date) and the
    rejected keys of each run under ``root/rejected_keys``.  The log table is the last
    event of each run; a run past retention gets a closing mark that hides it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _write(self, events: DataFrame) -> None:
        events.write.mode("append").partitionBy("started_on").parquet(f"{self.root}/events")

    def append(self, row: dict) -> None:
        full = {k: row.get(k) for k in _EVENT_COLS}
        full["event_at"] = full["event_at"] or full["finished_at"] or full["started_at"]
        full["started_on"] = full["started_at"].date()
        self._write(self.spark.createDataFrame([full], RUN_EVENT_SCHEMA))

    def append_events(self, events: DataFrame) -> None:
        """Events of many runs at once; absent columns are NULL."""
        have = set(events.columns)
        full = events.select(*[(F.col(c) if c in have else F.lit(None).cast(t)).alias(c)
                               for c, t in (x.split(maxsplit=1) for x in RUN_EVENT_SCHEMA.split(", "))])
        self._write(full.withColumn("event_at", F.coalesce("event_at", "finished_at", "started_at"))
                    .withColumn("started_on", F.to_date("started_at")))

    def reject(self, run_id: int, keys: DataFrame) -> None:
        """Keep the (one-column) rejected keys of a run, one row per key."""
        rows = keys.select(F.lit(run_id).cast("long").alias("id"), F.col(keys.columns[0]).cast("string").alias("key"))
        rows.write.mode("append").parquet(f"{self.root}/rejected_keys")

    def events(self) -> DataFrame:
        return self.spark.read.schema(RUN_EVENT_SCHEMA).parquet(f"{self.root}/events")

    def rejected_keys(self) -> DataFrame:
        return self.spark.read.schema(REJECTED_KEY_SCHEMA).parquet(f"{self.root}/rejected_keys")

    def table(self) -> DataFrame:
        return RL.latest_runs(self.events()).where(F.col("status") != EXPIRED).drop("event_at", "seq", "started_on")

    def abandon(self, now: _dt.datetime) -> None:
        """Close the runs that are still open (the service was restarted)."""
        self._write(RL.abandon_open(RL.latest_runs(self.events()), F.lit(now).cast("timestamp_ntz")))

    def expire(self, now: _dt.datetime, days: int = RUN_LOG_RETENTION_DAYS) -> None:
        """Hide runs started more than ``days`` before ``now``; days that lie wholly
        before that are deleted from the event folder."""
        at = F.lit(now).cast("timestamp_ntz")
        _, old = RL.expire(RL.latest_runs(self.events()).where(F.col("status") != EXPIRED), at, days)
        self._write(old.withColumns({"status": F.lit(EXPIRED), "event_at": F.greatest(at, "event_at"), "seq": F.col("seq") + 1}))
        limit = (now - _dt.timedelta(days=days)).date()
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(f"{self.root}/events")
        fs = root.getFileSystem(conf)
        for st in fs.listStatus(root):             # one folder per day
            name = st.getPath().getName()
            if name.startswith("started_on=") and name[11:] < limit.isoformat():
                fs.delete(st.getPath(), True)


def requested_date(now: _dt.datetime, given: str | None = None, cutoff_hour: int = BUSINESS_DAY_CUTOFF_HOUR,
                   tz: str = DEFAULT_TIMEZONE) -> _dt.date:
    """Business date of a run started at ``now`` (an instant, or a wall-clock time of
    ``tz``): a given ddMMyyyy date wins; before ``cutoff_hour`` in ``tz`` the run
    belongs to the previous day."""
    if given:
        return _dt.datetime.strptime(given, "%d%m%Y").date()
    local = now.astimezone(ZoneInfo(tz)) if now.tzinfo else now
    return (local - _dt.timedelta(days=1)).date() if local.hour < cutoff_hour else local.date()


# --------------------------------------------------------------------------- one feed, one run


def _load(spark, path, spec, store, form, mode, on_fraction, reject_key, reject) -> IngestResult:
    from tidemark.sources.feeds import read_feed
    with scratch(spark, "records") as at:
        records, lines = staged(read_feed(spark, path, form="lines" if form == "auto" else form), spark, f"{at}/lines")
        if form == "auto" and not lines["records"] and (lines["malformed"] or lines["status_messages"]):
            records, lines = staged(read_feed(spark, path, form="document"), spark, f"{at}/documents")     # no line is a record
        malformed = int(lines["malformed"] or 0)
        vocabulary, index = record_vocabulary(records, spec)
        plan = resolve_columns(vocabulary, spec)
        found = findings(plan, spec, received=int(lines["records"] or 0))
        warnings = [m for level, m in found if level == "warning"]
        errors = [m for level, m in found if level == "error"]
        if not lines["records"]:
            return IngestResult(STATUS_EMPTY, warnings=warnings, malformed=malformed)
        if errors:
            return IngestResult(STATUS_VALIDATION_FAILED, received=int(lines["records"]), error=errors[0], warnings=warnings, malformed=malformed)
        mi = MergeInput(conform(records, spec, plan, rec="rec", pos="pos", on_fraction=on_fraction,
                                require_flag=(mode == "bulk"), key_index=index), spec, plan.present)
        res = apply_feed(mi, store, mode=mode)
        if reject is not None and reject_key in mi.feed.columns:
            bad = has_null_key([k for k in mi.keys])
            reject(mi.feed.select(F.when(bad, qcol(reject_key)).alias("key")).where(F.col("key").isNotNull()).distinct())
        return replace(res, warnings=warnings, malformed=malformed)


def ingest(spark, path, spec, store, log: RunLog | None = None, feed_name: str | None = None,
           target_date: str | None = None, now: _dt.datetime | None = None, form: str = "auto",
           mode: str = "api", on_fraction: str = "fail", http_status: int | None = None,
           reject_key: str = "fincode", tz: str = DEFAULT_TIMEZONE) -> dict:
    """Read one feed (files at ``path``), apply it to ``store`` and log the run.

    ``http_status`` is the outcome of the transfer that brought the files: 204 gives
    NO_CONTENT, 403 and 404 give API_ERROR, and nothing is read.  Other statuses:
    SUCCESS, EMPTY (no records), VALIDATION_FAILED (key columns missing),
    TABLE_NOT_FOUND (no spec), FAILED (unstorable values, or an error)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    local = now.astimezone(ZoneInfo(tz)).replace(tzinfo=None) if now.tzinfo else now
    feed_name = feed_name or (spec.name if spec is not None else "unknown")
    run = {"id": uuid.uuid4().int >> 65, "feed_name": feed_name, "http_status": http_status,
           "requested_date": requested_date(now, target_date, tz=tz), "started_at": local}
    if log is not None:
        log.append(dict(run, status=STATUS_STARTED, seq=0))
    try:
        if spec is None:
            res = IngestResult(STATUS_TABLE_NOT_FOUND, error=f"No table found for feed={feed_name}")
        elif http_status == NO_CONTENT_CODE:
            res = IngestResult(STATUS_NO_CONTENT)
        elif http_status in API_ERROR_CODES:
            res = IngestResult(STATUS_API_ERROR, error=f"HTTP {http_status}")
        else:
            reject = None if log is None else lambda keys: log.reject(run["id"], keys)
            res = _load(spark, path, spec, store, form, mode, on_fraction, reject_key, reject)
    except Exception as e:                       # the run is logged as FAILED, never left open
        res = IngestResult(STATUS_FAILED, error=str(e))
    result = {"feed_name": feed_name, **res.as_row(), "rows_malformed": res.malformed, "warnings": res.warnings}
    if log is not None:
        took = _dt.datetime.now(_dt.timezone.utc).astimezone(ZoneInfo(tz)).replace(tzinfo=None)
        log.append(dict(run, seq=1, finished_at=max(took, local),
                        **{k: v for k, v in result.items() if k in _EVENT_COLS and k not in ("feed_name", "warnings")},
                        warnings=" | ".join(res.warnings) or None))
    return result
