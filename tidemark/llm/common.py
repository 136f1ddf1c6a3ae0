"""Shared pieces of the training-data operators: scratch tables in the folder
that all executors share, range-sorted numbering, and a byte-level word kernel.

Words here are maximal runs of bytes outside ``20 09-0D``, which on UTF-8 is the
same as the class ``[^\\x20\\x09-\\x0D]+`` over code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import hadoop_path, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """Within: a session setting has this value."""
    old = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, old)


@contextmanager
def _shuffle_files_freed(spark: SparkSession):
    """Within: a finished write gives its shuffle files back at once instead of
    when the driver happens to collect its garbage.  Nothing is read twice there."""
    with setting(spark, _CLEANUP, "true"):
        yield


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under spark.checkpoint.dir and read back: lineage is cut, and
    the rows survive lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffle_files_freed(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def released(*tables: DataFrame) -> None:
    """Delete stored tables that no frame in use reads any more."""
    for df in tables:
        fs, at = hadoop_path(df.sparkSession, df.stored_at)
        fs.delete(at, True)


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, order: list, name: str, partitions: int | None = None) -> DataFrame:
    """``df`` sorted over all partitions by ``order`` (a range partitioning with
    sampled splitters) and stored, with ``part`` and ``pos``: the partition, and
    the row's place in it from 0.  ``order`` must tell any two rows apart that
    must not be swapped."""
    parts = partitions or partitions_for(df.sparkSession)
    out = (df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
           .withColumn("_id", F.monotonically_increasing_id())
           .withColumn("part", F.shiftright("_id", 33).cast("int"))
           .withColumn("pos", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id"))
    return stored(out, name)


def text_slices(batches: Iterator[pa.RecordBatch], column: int,
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of about ``limit`` bytes of text (one row at least): the slice, its
    text bytes, and the n+1 row offsets into them.  Null text is empty."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        text = batch.column(column)
        if pa.types.is_large_string(text.type):
            kind = np.int64
        else:
            text, kind = text.cast(pa.string()), np.int32
        if text.null_count:
            text = text.fill_null("")
        bufs = text.buffers()
        offs = np.frombuffer(bufs[1], kind)[text.offset: text.offset + n + 1].astype(np.int64)
        data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
        a = 0
        while a < n:
            b = int(np.searchsorted(offs, offs[a] + limit, side="right")) - 1
            b = min(n, max(b, a + 1))
            yield batch.slice(a, b - a), data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
            a = b


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD_BYTES = ~_SPACE


def word_bounds(data: np.ndarray, offs: np.ndarray,
                word_bytes: np.ndarray = WORD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each row the number of its first
    word (n+1 entries).  No word reaches over the end of its row."""
    n = len(data)
    edge = np.zeros(n + 2, bool)
    edge[1:-1] = word_bytes[data]
    inside = edge[1:-1]
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    starts = np.flatnonzero(inside & (~edge[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside & (~edge[2:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_PI = np.uint64(pow(int(_P), -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES * 2)
        one = np.ones(1, np.uint64)
        _POWERS[:] = [np.concatenate([one, np.cumprod(np.full(size - 1, x, np.uint64))]) for x in (_P, _PI)]
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, by differences of a running polynomial."""
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):  # pieces of a few MB, whatever the length of a row
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + 2 * SLICE_BYTES, side="right")))
        lo, hi = int(starts[a]), int(ends[b - 1])
        up, down = _powers(hi - lo + 1)
        run = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=run[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = (run[e] - run[s]) * down[s]
        a = b
    return mix(out)


_Q = [np.uint64(pow(0xD6E8FEB86659FD93, j, 1 << 64)) for j in range(64)]


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words (len(words) - k + 1 of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += words[j:j + n] * _Q[j]
    return mix(out)


def within_rows(first: np.ndarray, total: int, k: int) -> np.ndarray:
    """Which of the ``total - k + 1`` runs of k words lie in one row."""
    n = max(0, total - k + 1)
    ok = np.ones(n, bool)
    for f in first[1:-1]:
        ok[max(0, f - k + 1):f] = False
    return ok


def span_hashes(words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of each run words[a:b], whatever its length, by differences of a running polynomial."""
    up, down = _powers(len(words) + 1)
    run = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:len(words)], out=run[1:])
    return mix((run[b] - run[a]) * down[a] + (b - a).astype(np.uint64))
