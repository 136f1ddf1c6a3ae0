"""Substring dedup by window hashes, in place of a relative Lempel-Ziv parse.

The reference of a document is every document with a smaller id.  No longest match and
no (reference, offset) of a copy is sought: the words that go are those of all windows
the reference has, and a parse would need all of its text in each task.  The texts are
cut into *reference blocks* that any two copies of a
passage cut alike: each window of ``window`` words is filed under its anchor, the
least-hashed run of ``ANCHOR`` words in it, and a block is the stretch of words of
all neighbouring windows with one anchor.

1. Index: per anchor the smallest and largest document that has it, and whether all
   its blocks read the same.  These are minima and maxima, so a passage in a third of
   all documents is one partial aggregate per task.  Anchors of one document go.
2. Marks: a document takes a whole block as copied when the anchor has one block text
   only and an earlier document.  Where the anchor has several block texts, a factor
   begins or ends inside the block: these boundary blocks are checked window by
   window, again by a minimum over the documents of each window.
3. Neighbouring copied windows are one span; the spans (``factors``) are at least
   ``window`` words long.

Two documents that share a window share its anchor, so no window is missed.  Texts
are compared as (anchor, block) or (anchor, window) hashes of 64 bits each.

Cases: null and empty texts have no words; documents below ``window`` words lose
nothing; rows with one id are not earlier than each other; a null id is later than
all others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import gram_hashes, load, span_hashes, stored, text_slices, within_rows, word_bounds, word_hashes

WINDOW = 13
ANCHOR = 5
LAST = (1 << 63) - 1


class Anchored:
    """The windows of a slice of texts: their first words, anchors, rows and hashes."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, window: int):
        self.starts, self.ends, self.first = word_bounds(data, offs)
        n = len(self.starts)
        self.window, self.words = window, word_hashes(data, self.starts, self.ends)
        k = min(ANCHOR, window)
        grams, span = gram_hashes(self.words, k), window - k + 1
        count = max(0, n - window + 1)
        least, place = grams[:count].copy(), np.zeros(count, np.int64)
        for j in range(1, span):
            other = grams[j:j + count]
            less = other < least
            least[less] = other[less]
            place[less] = j
        self.at = np.flatnonzero(within_rows(self.first, n, window))
        self.anchor = least[self.at]
        self.row = np.searchsorted(self.first, self.at, side="right") - 1
        where = self.at + place[self.at]
        new = np.ones(len(self.at), bool)
        new[1:] = (where[1:] != where[:-1]) | (self.at[1:] != self.at[:-1] + 1)
        self.block = np.cumsum(new) - 1  # of each window
        self.opens = np.flatnonzero(new)

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, text hash and row of each block."""
        closes = np.append(self.opens[1:], len(self.at)) - 1
        text = span_hashes(self.words, self.at[self.opens], self.at[closes] + self.window) if len(self.at) else np.zeros(0, np.uint64)
        return self.anchor[self.opens], text, self.row[self.opens]

    def window_hashes(self, which: np.ndarray) -> np.ndarray:
        return span_hashes(self.words, self.at[which], self.at[which] + self.window)

    def listed(self, keys: np.ndarray, lists: pa.ListArray, rows: np.ndarray) -> np.ndarray:
        """For each key of a row: whether the row's list has it."""
        flat, size = lists.flatten().to_numpy().view(np.uint64), np.asarray(lists.value_lengths().fill_null(0))
        of = np.repeat(np.arange(len(size)), size).astype(np.uint64)
        odd = np.uint64(0x9E3779B97F4A7C15)
        return np.isin(keys + rows.astype(np.uint64) * odd, flat + of * odd)


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def block_rows(rows: DataFrame, window: int) -> DataFrame:
    """anchor, block, doc_id of every block of every text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in text_slices(batches, 1):
            anchor, text, row = Anchored(data, offs, window).blocks()
            yield pa.RecordBatch.from_arrays([_long(anchor), _long(text), part.column(0).take(pa.array(row))], ["anchor", "block", "doc_id"])

    return rows.mapInArrow(work, "anchor long, block long, doc_id long")


def shared_anchors(blocks: DataFrame) -> DataFrame:
    """anchor, earliest, mixed: the anchors of at least two documents; ``mixed``: its blocks differ."""
    found = blocks.groupBy("anchor").agg(F.min("doc_id").alias("earliest"), F.max("doc_id").alias("latest"),
                                         F.min("block").alias("least"), F.max("block").alias("most"))
    return found.where("earliest < latest").select("anchor", "earliest", (F.col("least") < F.col("most")).alias("mixed"))


def boundary_windows(rows: DataFrame, window: int) -> DataFrame:
    """win, anchor, doc_id of the windows filed under the anchors listed in ``mixed``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in text_slices(batches, 1):
            a = Anchored(data, offs, window)
            which = np.flatnonzero(a.listed(a.anchor, part.column(2), a.row))
            yield pa.RecordBatch.from_arrays([_long(a.window_hashes(which)), _long(a.anchor[which]),
                                              part.column(0).take(pa.array(a.row[which]))], ["win", "anchor", "doc_id"])

    return rows.select("doc_id", "text", "mixed").mapInArrow(work, "win long, anchor long, doc_id long")


def _parse(rows: DataFrame, window: int) -> DataFrame:
    kept = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                      ("factors", pa.list_(pa.list_(pa.int64()))), ("kept", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in text_slices(batches, 1):
            a = Anchored(data, offs, window)
            dup = a.listed(a.anchor, part.column(2), a.row)
            if part.column(3).null_count < part.num_rows:
                rest = np.flatnonzero(~dup)
                dup[rest] = a.listed(a.window_hashes(rest), part.column(3), a.row[rest])
            step = np.zeros(len(a.starts) + 1, np.int64)
            np.add.at(step, a.at[dup], 1)
            np.add.at(step, a.at[dup] + window, -1)
            gone = np.cumsum(step[:-1]) > 0
            raw, out = data.tobytes(), []
            for i, key in enumerate(part.column(0).to_pylist()):
                words, g = raw[offs[i]:offs[i + 1]].split(), gone[a.first[i]:a.first[i + 1]]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8)))
                text = b" ".join(compress(words, (~g).tolist())) if len(edge) else b" ".join(words)
                out.append((key, len(words), int(g.sum()), edge.reshape(-1, 2).tolist(), text))
            cols = list(zip(*out))
            cols[4] = pa.array(cols[4], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(cols, kept)], schema=kept)

    return rows.select("doc_id", "text", "copied", "windows").mapInArrow(
        work, "doc_id long, n_words long, n_removed long, factors array<array<long>>, kept string")


def without_copies(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, factors, kept per row of ``docs``: the spans of words
    (start, end) copied from earlier documents, and the other words joined by one space."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = stored(shared_anchors(block_rows(rows, window)), "lz_index")
    # a frequent anchor is a skewed key here; its partition is split at run time, the index has it once
    told = (block_rows(rows, window).select("anchor", "doc_id").join(shared, "anchor").where("mixed or earliest < doc_id")
            .groupBy("doc_id").agg(F.collect_set(F.when(~F.col("mixed"), F.col("anchor"))).alias("copied"),
                                   F.collect_set(F.when(F.col("mixed"), F.col("anchor"))).alias("mixed")))
    told = stored(told, "lz_blocks")
    checked = stored(boundary_windows(rows.join(told.where(F.size("mixed") > 0), "doc_id"), window), "lz_windows")
    first = checked.groupBy("win", "anchor").agg(F.min("doc_id").alias("earliest"), F.max("doc_id").alias("latest")).where("earliest < latest")
    first = stored(first, "lz_first")  # and so is a frequent window here
    late = (checked.join(first.select("win", "anchor", "earliest"), ["win", "anchor"]).where("earliest < doc_id")
            .groupBy("doc_id").agg(F.collect_set("win").alias("windows")))
    lists = stored(told.select("doc_id", "copied").join(late, "doc_id", "left"), "lz_lists")
    out = _parse(rows.join(lists, "doc_id", "left"), window)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != LAST, F.col("doc_id")))


def op7_lz_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_copies(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.size("factors").cast("long").alias("n_factors"))


OP7_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS win
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS earliest FROM win) WHERE earliest < doc_id),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS places FROM dup GROUP BY doc_id),
runs AS (SELECT doc_id, count(*) AS n_factors FROM
           (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM dup) WHERE step IS NULL OR step > 13 GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN words
              ELSE list_transform(list_filter(list_zip(words, range(1, len(words) + 1)), lambda p: NOT list_contains(places, p[2])), lambda p: p[1]) END, ' ')) AS kept_sha256,
       coalesce(n_factors, 0)::BIGINT AS n_factors
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN runs USING (doc_id)
"""
