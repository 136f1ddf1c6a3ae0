"""Quality classifier by importance resampling.

Two bags of hashed n-grams are fitted: the *target* model on labelled good documents
(half of a bounded sample of labelled rows; all other labelled rows set the sample's
size) and the *raw* model on every document.  A
document's log importance weight is the sum over its n-grams of
``log p_target - log p_raw``.  Gumbel noise, a hash of the document's id, is added,
and the k largest keys are the sample: k draws without replacement in proportion to
the weights.  ``k`` is either given or the smallest sample that holds a stated share
of the labelled good documents.

Features of a text: its tokens (runs of letters, of digits, of signs), pairs of
tokens, and triples of token shapes (lower case, capitalised, capitals, digits, a
repeat of the token before, or the signs themselves), each hashed to one of
``BUCKETS``.  The target model is smoothed towards the raw one, so that n-grams too
rare to judge weigh nothing.

Cases: null and empty texts have no n-gram and log weight 0; labels of unknown
documents do not count, several labels of one document count as its worst; rows with
one id get one noise; a null id gets a noise of its own; without good labels every
weight is 0 and, unless k is given, every row is kept; an empty table gives an empty
result; other columns stay untouched in ``kept_rows``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import load, mix, numbered, stored, text_slices, word_hashes

BUCKETS = 1 << 15
LABELLED = 20_000  # labelled rows the target model is fitted on, at most
SHRINK = 32.0  # weight of the raw model in the target model, in n-grams per bucket
RECALL = 0.995  # share of labelled good documents that the sample holds
_KIND = np.full(256, 3, np.uint8)  # signs
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x30, 0x3A)]] = 2
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def features(data: np.ndarray, offs: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every n-gram of a slice of texts."""
    kind = _KIND[data]
    n = len(data)
    change = np.ones(n + 1, bool)
    if n:
        change[1:-1] = kind[1:] != kind[:-1]
    change[offs] = True
    edge = np.flatnonzero(change)
    starts, ends = edge[:-1], edge[1:]
    real = kind[starts] > 0 if n else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.searchsorted(offs, starts, side="right") - 1
    what, size = kind[starts], ends - starts
    token = word_hashes(_LOWER[data], starts, ends)
    token[what == 2] = np.uint64(2)
    capitals = np.concatenate([[0], np.cumsum((data >= 0x41) & (data <= 0x5A))])
    upper = capitals[ends] - capitals[starts]
    shape = np.where(what == 1, np.where(upper == 0, 11, np.where((upper == size) & (size > 1), 13, 12)), 14).astype(np.uint64)
    shape = np.where(what == 3, token, shape)
    again = np.zeros(len(token), bool)
    again[1:] = (token[1:] == token[:-1]) & (what[1:] == 1) & (row[1:] == row[:-1])
    shape[again] = np.uint64(19)
    pair = token[:-1] * np.uint64(0x9E3779B97F4A7C15) + token[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    triple = (shape[:-2] * np.uint64(0x165667B19E3779F9) + shape[1:-1] * np.uint64(0x27D4EB2F165667C5)
              + shape[2:] * np.uint64(0x85EBCA77C2B2AE63) + np.uint64(1))
    two, three = row[1:] == row[:-1], row[2:] == row[:-2]
    grams = np.concatenate([mix(token + np.uint64(3)), mix(pair[two]), mix(triple[three])])
    return (grams % np.uint64(buckets)).astype(np.int64), np.concatenate([row, row[1:][two], row[2:][three]])


def labelled(labels: DataFrame) -> DataFrame:
    """doc_id, good, held of every labelled document; ``held``: kept out of the fit."""
    each = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    good = (F.coalesce("quality", F.lit(0)) >= 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    held = F.xxhash64("doc_id").bitwiseAND(F.lit(1)) == 1
    return each.select("doc_id", good.alias("good"), held.alias("held"))


def labelled_good(labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """doc_id, good, held for at most ``limit`` labelled documents, in the order of a hash."""
    return labelled(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def log_ratios(raw: np.ndarray, target: np.ndarray, shrink: float = SHRINK) -> np.ndarray:
    """log p_target - log p_raw per bucket, the target smoothed towards the raw model."""
    if not target.sum():
        return np.zeros(len(raw))
    p = np.maximum(raw, 0.5) / np.maximum(raw, 0.5).sum()
    mu = shrink * len(raw)
    return np.log((target + mu * p) / (target.sum() + mu)) - np.log(p)


def fit(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The log ratio of each bucket, from rows (doc_id, text, good).  Each task counts
    its own texts and hands on one row per bucket; what reaches the driver has the
    size of the model, whatever the corpus."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for part, data, offs in text_slices(batches, 1):
            bucket, row = features(data, offs, buckets)
            raw += np.bincount(bucket, minlength=buckets)
            good = part.column(2).fill_null(False).to_numpy(zero_copy_only=False)
            if good.any():
                target += np.bincount(bucket[good[row]], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], ["bucket", "raw", "target"])

    sums = (rows.select("doc_id", "text", "good").mapInArrow(work, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    got = sums.toPandas()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[got.bucket], target[got.bucket] = got.raw, got.target
    return log_ratios(raw, target)


def weigh(rows: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, text_key, n_grams, log_weight of rows (doc_id, text, text_key)."""
    shared = rows.sparkSession.sparkContext.broadcast(ratios)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for part, data, offs in text_slices(batches, 1):
            bucket, row = features(data, offs, len(table))
            n = np.bincount(row, minlength=part.num_rows)
            w = np.bincount(row, weights=table[bucket], minlength=part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n), pa.array(w.astype(np.float64))],
                                             ["doc_id", "text_key", "n_grams", "log_weight"])

    return rows.select("doc_id", "text", "text_key").mapInArrow(
        work, "doc_id long, text_key long, n_grams long, log_weight double")


def gumbel(seed: int, *cols: str):
    """Standard Gumbel noise from a hash of the columns: reruns draw alike."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def scored(docs: DataFrame, labels: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, good (labelled good and not fitted on), n_grams, log_weight, key
    of every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = stored(labelled_good(labels), "importance_labels")
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    ratios = fit(rows.join(F.broadcast(known), "doc_id", "left").withColumn("good", F.col("good") & ~F.col("held")))
    fitted = F.broadcast(known.where(~F.col("held")).select("doc_id"))
    others = labelled(labels).join(fitted, "doc_id", "left_anti").where("good").select("doc_id", "good", F.lit(0).alias("_deal"))
    # rows without id meet no label and must not all go to one task
    out = weigh(rows, ratios).withColumn("_deal", F.when(F.col("doc_id").isNull(), F.spark_partition_id()).otherwise(F.lit(0)))
    out = out.join(others, ["doc_id", "_deal"], "left").drop("_deal").withColumn("key", F.col("log_weight") + gumbel(seed, "doc_id"))
    return stored(out, "importance_keys")


def rank_at(ranks: DataFrame, share: float) -> int | None:
    """The percentile of the column ``rank``, rounded up, with no more on the driver than
    one count per partition; None without rows."""
    placed = numbered(ranks.select("rank"), [F.col("rank")], "importance_good")
    counts = sorted(tuple(r) for r in placed.groupBy("part").count().collect())
    n = sum(c for _, c in counts)
    if not n:
        return None

    def rank(i: int) -> int:
        for part, c in counts:
            if i < c:
                return placed.where((F.col("part") == part) & (F.col("pos") == i)).first()["rank"]
            i -= c

    at = share * (n - 1)
    low, high = math.floor(at), math.ceil(at)
    return rank(low) if low == high else math.ceil((high - at) * rank(low) + (at - low) * rank(high))


def resample(keys: DataFrame, k: int | None = None, recall: float = RECALL) -> DataFrame:
    """``keys`` with ``rank`` (from 1, largest key first) and ``kept``: rank <= k.
    Without k: the smallest sample with ``recall`` of the good rows not fitted on."""
    placed = numbered(keys, [F.col("key").desc(), F.col("doc_id").asc_nulls_last(), F.col("text_key")], "importance_order")
    counts = sorted(tuple(r) for r in placed.groupBy("part").count().collect())
    before, rows = 0, []
    for part, n in counts:  # one row per partition
        rows.append((part, before))
        before += n
    starts = keys.sparkSession.createDataFrame(rows, "part int, before long")
    ranked = placed.join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + F.col("pos") + 1).drop("part", "pos", "before")
    if k is None:
        k = rank_at(ranked.where("good"), recall)
        k = before if k is None else k
    return ranked.withColumn("kept", F.col("rank") <= F.lit(k))


def kept_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in the sample, all columns unchanged."""
    gone = resample(scored(docs, labels, id_col=id_col, text_col=text_col), **options).where(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    met = F.col("gone_id").eqNullSafe(docs[id_col].cast("long")) & (F.col("gone_key") == F.xxhash64(docs[text_col].cast("string")))
    return docs.join(gone, met, "left_anti")


def op1_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(scored(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_grams", "log_weight", "key", "rank", "kept")
