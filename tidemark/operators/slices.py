"""Fixed-size slices of a feed, and the changes each slice makes.

A slice is a run of ``size`` lines or rows in order of arrival.  Numbering is distributed:
rows are numbered inside their partition (or file block), and the counts of the partitions
before give the offset; no task sees more than its own part.

:func:`slice_changes` applies the slices one after the other without a loop: the last row
of a key in each slice is an aggregate, its state before is the last effective row of an
earlier slice (a window over at most one row per key and slice) or else the target's row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators import merge as M
from tidemark.operators.merge import MergeInput
from tidemark.operators.normalize import qcol
from tidemark.operators.quality import has_null_key
from tidemark.session import scratch_path
from tidemark.spec import FLAG_DELETE, UPSERT_FLAGS

_IN_PART = (1 << 33) - 1     # monotonically_increasing_id: partition number above, row below


def _with_offsets(stored: DataFrame, value: Column, total: str) -> DataFrame:
    """``stored`` (with ``_part``) and ``_before``: the sum of ``value`` in all partitions
    before.  One number per partition passes through the driver."""
    sums = sorted((r["_part"], r["n"]) for r in stored.groupBy("_part").agg(F.sum(value).cast("bigint").alias("n")).collect())
    before, rows = 0, []
    for part, n in sums:
        rows.append((part, before))
        before += n
    offsets = stored.sparkSession.createDataFrame(rows, f"_part long, {total} long")
    return stored.join(F.broadcast(offsets), "_part")


def row_numbers(df: DataFrame, *order: Column | str, name: str = "line") -> DataFrame:
    """``df`` with its rows numbered from 0 in ``order`` (which must tell rows apart): a
    range partitioning with sampled splitters, each partition sorted and numbered in its
    own task and stored once."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    path = scratch_path(spark, "numbered")
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path).withColumn("_part", F.shiftright("_id", 33))
    numbered = _with_offsets(stored, F.lit(1), "_before")
    return numbered.withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(F.lit(_IN_PART))).drop("_id", "_part", "_before")


def line_numbers(lines: DataFrame, pos: str = "pos", name: str = "line") -> DataFrame:
    """Stored lines of text files (``pos``: file, block, row, as the reader gives it) with
    their number from 0: files in name order, lines in file order.  The table of blocks
    has one row per file split; it is numbered like any other rows."""
    p = F.col(pos)
    blocks = lines.groupBy(p.getField("file").alias("_file"), p.getField("block").alias("_block")).agg(
        F.min(p.getField("row")).alias("_first"), F.count("*").alias("_n"))
    path = scratch_path(lines.sparkSession, "blocks")
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = blocks.repartitionByRange(parts, "_file", "_block").withColumn("_part", F.shiftright(F.monotonically_increasing_id(), 33))
    ranged.write.parquet(path)
    stored = _with_offsets(lines.sparkSession.read.schema(ranged.schema).parquet(path), F.col("_n"), "_before")
    earlier = Window.partitionBy("_part").orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    stored = stored.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    here = lines.withColumns({"_file": p.getField("file"), "_block": p.getField("block")})
    return (here.join(stored.select("_file", "_block", "_first", "_start"), ["_file", "_block"])
            .withColumn(name, F.col("_start") + p.getField("row") - F.col("_first")).drop("_file", "_block", "_first", "_start"))


def slice_of(line: str, size: int) -> Column:
    return F.floor(F.col(line) / F.lit(size)).cast("bigint")


def slice_summary(numbered: DataFrame, size: int, line: str = "line") -> DataFrame:
    """slice, first_line, last_line, rows."""
    return (numbered.groupBy(slice_of(line, size).alias("slice"))
            .agg(F.min(line).alias("first_line"), F.max(line).alias("last_line"), F.count("*").alias("rows")))


def slice_winners(mi: MergeInput, slice_col: str = "slice") -> DataFrame:
    """The last row of each key in each slice: slice, key, ``_s`` (the row's written
    columns and flag), ``_n`` (rows of the key in the slice).  NULL keys come as groups."""
    cols = [c for c in mi.written if c != "flag"] + ["flag"]
    row = F.max_by(F.struct(*[qcol(c) for c in cols]), F.col("pos"))
    return mi.feed.groupBy(slice_col, *[qcol(k) for k in mi.keys]).agg(row.alias("_s"), F.count("*").alias("_n"))


def slice_changes(mi: MergeInput, target: DataFrame, slice_col: str = "slice") -> DataFrame:
    """slice, key, ``_n``, ``action`` of each key and slice, as if the slices were merged
    one after the other.  The feed carries the same columns in every slice."""
    keys, written = mi.keys, mi.written
    won = slice_winners(mi, slice_col)
    effective = F.when(F.col("_s.flag").isin(FLAG_DELETE, *UPSERT_FLAGS), F.col("_s"))
    earlier = Window.partitionBy(*[qcol(k) for k in keys]).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    fed = won.where(~has_null_key(keys)).withColumn("_prev", F.last(effective, ignorenulls=True).over(earlier))
    held = target.select(*[qcol(k) for k in keys], F.struct(*[qcol(c) for c in written], F.lit(True).alias("_there")).alias("_t"))
    j = held.join(fed, keys, "right_outer")
    prev, t, s = F.col("_prev"), F.col("_t"), F.col("_s")
    there = F.when(prev.isNotNull(), prev.getField("flag") != FLAG_DELETE).otherwise(t.isNotNull())
    same = lambda x: F.struct(*[x.getField(c).alias(c) for c in written])
    alike = F.when(prev.isNotNull(), same(s).eqNullSafe(same(prev))).otherwise(same(s).eqNullSafe(same(t))) if written else F.lit(True)
    flag = s.getField("flag")
    action = (F.when(flag == FLAG_DELETE, F.when(there, "delete").otherwise("no_match"))
              .when(flag.isin(*UPSERT_FLAGS), F.when(~there, "insert").when(alike, "unchanged").otherwise("update"))
              .otherwise("ignored"))
    fed = j.select(slice_col, *[qcol(k) for k in keys], "_n", action.alias("action"))
    none = won.where(has_null_key(keys)).select(slice_col, *[qcol(k) for k in keys], "_n", F.lit("rejected").alias("action"))
    return fed.unionByName(none)


def slice_totals(changes: DataFrame, slice_col: str = "slice") -> DataFrame:
    """slice, received, inserted, updated, deleted, unchanged, rejected (received rows that
    are none of these)."""
    counted = changes.groupBy(slice_col).agg(F.sum("_n").cast("bigint").alias("received"), *M.count_columns(F.col("action"))[:4])
    done = F.col("inserted") + F.col("updated") + F.col("deleted") + F.col("unchanged")
    return counted.select(slice_col, "received", "inserted", "updated", "deleted", "unchanged", (F.col("received") - done).alias("rejected"))


def feed_totals(per_slice: DataFrame) -> DataFrame:
    """The sums over all slices."""
    names = ("received", "inserted", "updated", "deleted", "unchanged", "rejected")
    return per_slice.agg(F.count("*").alias("slices"), *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in names])
