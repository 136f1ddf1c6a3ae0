"""Run log: append-only events, latest state per run, retention, missed runs.

A run is opened with a ``STARTED`` event and closed with a finishing event
(same ``id``); the log table is the latest event per ``id``.  Appending instead
of updating keeps the log an immutable table that any number of jobs can write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import older_than
from tidemark.operators.dedup import keep_last
from tidemark.spec import (ABANDON_MESSAGE, API_ERROR_CODES, NO_CONTENT_CODE, DONE_STATUSES, STATUS_ABANDONED, STATUS_API_ERROR, STATUS_EMPTY,
                           STATUS_FAILED, STATUS_NO_CONTENT, STATUS_STARTED, STATUS_SUCCESS,
                           STATUS_TABLE_NOT_FOUND, STATUS_VALIDATION_FAILED, SUCCEEDED_STATUSES)

COUNTERS = ("rows_received", "rows_inserted", "rows_updated", "rows_deleted", "rows_unchanged", "rows_rejected")


def processed_rows(given=None) -> Column:
    """Rows that changed the table: given value, else inserted + updated + deleted."""
    derived = F.col("rows_inserted") + F.col("rows_updated") + F.col("rows_deleted")
    if given is None:
        return derived
    g = F.col(given) if isinstance(given, str) else given
    return F.when(F.coalesce(g, F.lit(0)) != 0, g).otherwise(derived)


def latest_runs(events: DataFrame, order: str = "seq") -> DataFrame:
    """Log table: the last event of each run id (an update in place, as data).  Events
    with a time are ordered by it, then by ``order``: a run that was given up and
    finishes afterwards counts as finished."""
    if "event_at" not in events.columns:
        return keep_last(events, ["id"], order)
    placed = events.withColumn("_at", F.struct("event_at", order))
    return keep_last(placed, ["id"], "_at").drop("_at")


def run_status(received, error=None, validation_error=None, http_status=None, table_found=None) -> Column:
    """Status of a feed run, first match wins: TABLE_NOT_FOUND (no table for the
    feed), NO_CONTENT (HTTP 204), API_ERROR (HTTP 403 / 404), FAILED (an error),
    VALIDATION_FAILED, EMPTY (no rows received), else SUCCESS.  Arguments name
    columns; transport outcomes arrive as data (``http_status``)."""
    st = F.when(F.lit(False), F.lit(None))
    if table_found is not None:
        st = st.when(~F.col(table_found), STATUS_TABLE_NOT_FOUND)
    if http_status is not None:
        h = F.col(http_status)
        st = st.when(h == NO_CONTENT_CODE, STATUS_NO_CONTENT).when(h.isin(*API_ERROR_CODES), STATUS_API_ERROR)
    if error is not None:
        st = st.when(F.col(error).isNotNull(), STATUS_FAILED)
    if validation_error is not None:
        st = st.when(F.col(validation_error).isNotNull(), STATUS_VALIDATION_FAILED)
    return st.when(F.coalesce(F.col(received), F.lit(0)) == 0, STATUS_EMPTY).otherwise(STATUS_SUCCESS)


def expire(log: DataFrame, now, days: int, ts: str = "started_at") -> tuple[DataFrame, DataFrame]:
    """(kept, expired): runs started more than ``days`` before ``now``."""
    old = older_than(ts, now if isinstance(now, Column) else F.lit(now), days)
    return log.where(~old), log.where(old)


def abandon_open(log: DataFrame, now) -> DataFrame:
    """Finishing events for runs still STARTED (service restart): ABANDONED with a
    message and a finish time; append them to the events."""
    now_c = now if isinstance(now, Column) else F.lit(now)
    open_runs = log.where(F.col("status") == STATUS_STARTED)
    return open_runs.select(
        *[F.col(c) for c in log.columns if c not in ("status", "error_message", "finished_at", "seq", "event_at")],
        F.lit(STATUS_ABANDONED).alias("status"),
        F.lit(ABANDON_MESSAGE).alias("error_message"),
        now_c.cast(log.schema["finished_at"].dataType if "finished_at" in log.columns else "timestamp_ntz").alias("finished_at"),
        (F.col("seq") + 1).alias("seq") if "seq" in log.columns else F.lit(1).alias("seq"),
        *([now_c.cast("timestamp_ntz").alias("event_at")] if "event_at" in log.columns else []),
    ).select(*log.columns)


def done_runs(log: DataFrame) -> DataFrame:
    return log.where(F.col("status").isin(*DONE_STATUSES))


def expected_runs(feeds: DataFrame, first, last) -> DataFrame:
    """(feed_name, requested_date): every feed on every day from ``first`` to ``last``."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))
    return feeds.select("feed_name", F.explode(days).alias("requested_date"))


def missed_runs(expected: DataFrame, log: DataFrame) -> DataFrame:
    """Expected (feed_name, requested_date) pairs with no SUCCESS, STARTED or
    NO_CONTENT run."""
    done = done_runs(log).select("feed_name", "requested_date")
    return expected.select("feed_name", "requested_date").join(done, ["feed_name", "requested_date"], "left_anti")


def run_counts(log: DataFrame) -> DataFrame:
    """COUNT(*) of runs by feed, date and status."""
    return log.groupBy("feed_name", "requested_date", "status").agg(F.count(F.lit(1)).alias("runs"))


def run_summary(log: DataFrame, by: list[str]) -> DataFrame:
    """Per group: runs, succeeded (SUCCESS or NO_CONTENT), and the feeds that did not
    succeed (sorted, distinct; a group holds at most the feed catalogue)."""
    ok = F.col("status").isin(*SUCCEEDED_STATUSES)
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(ok).alias("succeeded"),
        F.array_join(F.array_sort(F.collect_set(F.when(~ok, F.col("feed_name")))), ",").alias("not_succeeded"),
    )

