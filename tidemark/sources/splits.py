"""Large JSON documents, each read by many tasks.

A document ``{"Table":[{…},{…}]}`` or ``[{…},{…}]`` of any size, with or without line
breaks, is read through the text source with ``}`` as the line separator, so Spark cuts it
into byte ranges like any other text.  What a split starts in (a string or not, how deep
in brackets) depends on all text before it; that is found by a prefix scan:

1. each split reports its quotes, and its change of depth both for a start inside and
   outside a string (one row per split);
2. running sums over a file's splits give every split its true start;
3. each split, knowing its start, cuts out its records in one pass over its bytes, and
   reports what lies outside them.  A record that crosses splits comes as pieces, which are
   put together per record.

Records are parsed where they were cut.  What lies outside the records, with one mark for
the records themselves, must be such a document and nothing else (commas between records
are checked in place); then the document is *regular* and its records are the result.
Any other document is left to the whole-document reader, which takes files up to
``WHOLE`` bytes; above that it is malformed.

Bytes are scanned with numpy inside ``mapInArrow``; the table of splits, one row per split
(some 100 bytes for 128 MB of text), is the only thing broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.text import is_status_message
from tidemark.session import scratch_path

#: Documents above this many bytes are read in splits.
SPLIT_OVER = 32 << 20
#: Irregular documents above this many bytes are not read as a whole.
WHOLE = 1 << 30
#: Text outside records that a split passes on.
OUTSIDE = 1 << 20
# Marks in the text outside records: the records of a split; a record cut by a split's edge.
RECORDS, EDGE = "\x00", "\x02"
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0D])
_SPLITS = "file string, block long, bytes long, quotes long, outside long, inside long, opening int"
_CUT = "file string, block long, at long, kind int, text binary, odd long"
RECORD, HEAD, TAIL, REST = range(4)


def fragments(spark: SparkSession, path, over: int) -> DataFrame:
    """value, file, block, size: the text up to each ``}`` of the files above ``over`` bytes."""
    text = spark.read.option("lineSep", "}").text(path)
    meta = F.col("_metadata")
    return (text.where(meta.getField("file_size") > over)
            .select("value", meta.getField("file_path").alias("file"), meta.getField("file_block_start").alias("block"),
                    meta.getField("file_size").alias("size")))


def _joined(column: pa.Array) -> np.ndarray:
    """The bytes of some fragments, each with its ``}`` again."""
    n, offs = len(column), np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offs[0]:offs[-1]] if raw is not None else np.zeros(0, np.uint8)
    out = np.full(len(data) + n, ord("}"), np.uint8)
    own = np.ones(len(out), bool)
    own[offs[1:] - offs[0] + np.arange(n)] = False
    out[own] = data
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
    """The batches by (file, block): rows of a split come one after the other."""
    def pieces():
        for batch in batches:
            if not batch.num_rows:
                continue
            block, file = batch.column(2).to_numpy(), batch.column(1).dictionary_encode().indices.to_numpy()
            edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                part = batch.slice(int(a), int(b - a))
                yield (part.column(1)[0].as_py(), part.column(2)[0].as_py()), part

    for key, parts in groupby(pieces(), key=lambda x: x[0]):
        yield key, (p for _, p in parts)


def _quotes(data: np.ndarray) -> np.ndarray:
    """Which bytes are quotes that open or close a string.  The text before ended with
    ``}``, so no escape reaches in."""
    quote = data == ord('"')
    slash = data == ord("\\")
    if slash.any():
        at = np.flatnonzero(quote)
        plain = np.maximum.accumulate(np.where(slash, -1, np.arange(len(data))))
        run = np.where(at > 0, at - 1 - plain[at - 1], 0)
        quote[at[run % 2 == 1]] = False
    return quote


def _nesting(data: np.ndarray) -> np.ndarray:
    """+1 for an opening bracket, -1 for a closing one."""
    step = np.zeros(len(data), np.int8)
    step[(data == ord("{")) | (data == ord("["))] = 1
    step[(data == ord("}")) | (data == ord("]"))] = -1
    return step


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: bytes, quotes, change of depth for a start outside and inside a
    string, first byte that is no space."""
    for (file, block), parts in _runs(batches):
        size, quotes, change, opening = 0, 0, [0, 0], -1
        for part in parts:
            data = _joined(part.column(0))
            if opening < 0 and not _SPACE[data].all():
                opening = int(data[np.argmin(_SPACE[data])])
            quote, step = _quotes(data), _nesting(data)
            odd = (np.cumsum(quote) & 1).astype(bool)
            for start in range(2):  # the same bytes lie inside strings for one start, outside for the other
                change[start] += int(step[odd == bool((start + quotes) % 2)].sum(dtype=np.int64))
            size += len(data)
            quotes += int(quote.sum())
        yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "bytes": size, "quotes": quotes, "outside": change[0],
                                           "inside": change[1], "opening": opening}], pa.schema(
            [("file", pa.string()), ("block", pa.int64()), ("bytes", pa.int64()), ("quotes", pa.int64()), ("outside", pa.int64()),
             ("inside", pa.int64()), ("opening", pa.int32())]))


def split_starts(frags: DataFrame) -> DataFrame:
    """Per split: file, block, quoted (starts inside a string), depth, base (depth around the
    records; 0: no document), last (of its file); of the file: total (bytes of all its
    fragments), end (depth at its end), open_string."""
    found = frags.select("value", "file", "block").mapInArrow(_summaries, _SPLITS)
    path = scratch_path(frags.sparkSession, "splits")
    found.write.parquet(path)
    splits = frags.sparkSession.read.schema(_SPLITS).parquet(path)
    by_file = Window.partitionBy("file").orderBy("block")
    before, all_of = by_file.rowsBetween(Window.unboundedPreceding, -1), by_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    s = splits.withColumn("quoted", (zero(F.sum("quotes").over(before)) % 2) == 1)
    s = s.withColumn("change", F.when(F.col("quoted"), F.col("inside")).otherwise(F.col("outside")))
    s = s.withColumn("depth", zero(F.sum("change").over(before)))
    first = F.first(F.when(F.col("opening") >= 0, F.col("opening")), ignorenulls=True).over(all_of)
    return s.select("file", "block", "quoted", "depth",
                    F.when(first == ord("{"), 2).when(first == ord("["), 1).otherwise(0).alias("base"),
                    F.sum("bytes").over(all_of).alias("total"), (F.sum("change").over(all_of)).alias("end"),
                    (F.sum("quotes").over(all_of) % 2 == 1).alias("open_string"),
                    (F.col("block") == F.max("block").over(all_of)).alias("last"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each split and what lies outside them.  Columns: value, file, block,
    quoted, depth, base, short."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("kind", pa.int32()), ("text", pa.binary()), ("odd", pa.int64())])

    def out(file, block, at, kind, text, odd=None):
        n = len(text)
        return pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array([block] * n, pa.int64()), pa.array(at, pa.int64()), pa.array([kind] * n, pa.int32()),
                                           pa.array(text, pa.binary()), pa.array([odd] * n, pa.int64())], schema=schema)

    for (file, block), parts in _runs(batches):
        quoted = depth = base = short = None
        held, begun = b"", None       # text of the record or gap at hand, where the record begins (-1: in an earlier split)
        before, crossed, odd, seen, room = b"", False, 0, False, True

        def scan(data: np.ndarray, start: int) -> Iterator[pa.RecordBatch]:
            """``data`` begins ``start`` bytes into the split."""
            nonlocal quoted, depth, held, begun, before, odd, seen
            quote, step = _quotes(data), _nesting(data)
            step[((np.cumsum(quote) + quoted) & 1).astype(bool)] = 0
            level = depth + np.cumsum(step, dtype=np.int64)
            edge = (((step == 1) & (data == ord("{")) & (level == base + 1)) | ((step == -1) & (data == ord("}")) & (level == base)))
            raw, a, texts, at = data.tobytes(), 0, [], []
            for i in np.flatnonzero(edge).tolist():
                opening = step[i] == 1
                if opening == (begun is not None):
                    odd += 1                      # brackets do not match
                elif opening:
                    gap = held + raw[a:i]
                    if not seen:
                        before = gap
                    elif gap.strip(b" \t\r\n") != b",":
                        odd += 1
                    held, begun, seen, a = b"", start + i, True, i
                else:
                    text = held + raw[a:i + 1]
                    if begun < 0:
                        yield out(file, block, [-1], HEAD, [text])
                    else:
                        texts.append(text)
                        at.append(begun)
                    held, begun, seen, a = b"", None, True, i + 1
            held += raw[a:]
            if texts:
                yield out(file, block, at, RECORD, texts)
            quoted = (int(quote.sum()) + quoted) % 2
            depth = int(level[-1]) if len(level) else depth

        done, kept = 0, b""                       # ``kept``: the last bracket, until it is known whether it is in the file
        for part in parts:
            if base is None:
                quoted, depth, base, short = (int(part.column(j)[0].as_py()) for j in range(3, 7))
                if depth > base:
                    begun, crossed = -1, True
            room = room and base > 0 and (begun is not None or len(held) <= OUTSIDE)
            if not room:                          # no document, or too much outside records: not read on
                continue
            data = np.concatenate([np.frombuffer(kept, np.uint8), _joined(part.column(0))])
            yield from scan(data[:-1], done)
            done, kept = done + len(data) - 1, b"}"
        if room and not short:
            yield from scan(np.frombuffer(kept, np.uint8), done)
        cut = begun is not None
        rest = before if not crossed else EDGE.encode()
        if not room or len(before) > OUTSIDE or (not cut and len(held) > OUTSIDE):
            yield out(file, block, [0], REST, [b""], 1)
            continue
        if cut:
            yield out(file, block, [begun], HEAD if begun < 0 else TAIL, [held])
        if crossed and begun == -1:
            rest = b""                            # all of the split lies inside one record
        elif not seen:
            rest = held
        else:
            rest += RECORDS.encode() + (EDGE.encode() if cut else held)
        yield out(file, block, [0], REST, [rest], odd)


def _whole_text(parts: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(parts), lambda x: x.getField("text")), "")


def split_documents(spark: SparkSession, path, over: int, parse, options: dict) -> tuple[DataFrame, DataFrame]:
    """The documents above ``over`` bytes: (documents, records).

    documents: file, size, sound (records and commas in order, all read to the end), n
    (records), messages (status messages among them), first (place of the first record),
    base, shown (the text outside the records, ``{}`` standing for all of them).  records:
    file, block, at, rec, stored.  ``parse`` is the schema of an array of records,
    ``options`` those of the JSON parser."""
    frags = fragments(spark, path, over)
    starts = split_starts(frags)
    at = scratch_path(spark, "split-starts")
    starts.write.parquet(at)
    starts = spark.read.parquet(at)
    per_split = starts.select("file", "block", F.col("quoted").cast("int").alias("quoted"), "depth", "base", "total", "last")
    given = frags.join(F.broadcast(per_split), ["file", "block"])
    # a file that does not end with the separator gains one by it
    short = (F.col("last") & (F.col("total") - F.col("size") == 1)).cast("int")
    at = scratch_path(spark, "split-cut")
    (given.select("value", "file", "block", "quoted", "depth", "base", short.alias("short")).mapInArrow(_cut, _CUT).write.parquet(at))
    cut = spark.read.schema(_CUT).parquet(at)
    crossing = cut.where(F.col("kind").isin(HEAD, TAIL))
    by_file = Window.partitionBy("file").orderBy("block", "kind")
    crossing = crossing.withColumn("no", F.sum((F.col("kind") == TAIL).cast("int")).over(by_file))
    joined = crossing.groupBy("file", "no").agg(F.min(F.struct("block", "kind", "at")).alias("s"), F.collect_list(F.struct("block", "kind", "text")).alias("p"))
    pieces = F.transform(F.array_sort("p"), lambda x: x.getField("text"))
    joined = joined.select("file", F.col("s.block").alias("block"), F.col("s.at").alias("at"), F.aggregate(pieces, F.lit(b""), lambda a, x: F.concat(a, x)).alias("text"))
    texts = cut.where(F.col("kind") == RECORD).select("file", "block", "at", "text").unionByName(joined)
    text = F.col("text").cast("string")
    rec = F.from_json(F.concat(F.lit("["), text, F.lit("]")), parse, options)
    parsed = texts.select("file", "block", "at", F.when(F.size(rec) == 1, rec.getItem(0)).alias("rec"))
    at = scratch_path(spark, "split-records")
    parsed.write.parquet(at)
    records = spark.read.schema(parsed.schema).parquet(at)
    counted = records.groupBy("file").agg(F.count("*").alias("n"), F.count_if(F.col("rec").isNull()).alias("bad"),
                                          F.count_if(is_status_message("rec")).alias("messages"), F.min(F.struct("block", "at")).alias("first"))
    rest = (cut.where(F.col("kind") == REST).groupBy("file")
            .agg(_whole_text(F.collect_list(F.struct("block", F.col("text").cast("string").alias("text")))).alias("rest"), F.sum("odd").alias("odd")))
    sizes = _sizes(spark, path, over)
    ends = starts.where("last").select("file", "base", "total", "end", "open_string")
    docs = ends.join(sizes, "file").join(rest, "file").join(counted, "file", "left")
    added = F.col("total") - F.col("size")       # below 0: a byte order mark, which no reader of documents takes
    end = F.when(added == 1, F.col("end") + 1).otherwise(F.col("end"))
    parts = F.split(F.regexp_replace("rest", f"{RECORDS}({EDGE}{EDGE}{RECORDS})+", RECORDS), RECORDS)
    docs = docs.withColumn("parts", parts).withColumn("k", F.size("parts"))
    gaps = F.when(F.col("k") > 2, F.forall(F.slice("parts", F.lit(2), F.greatest(F.col("k") - 2, F.lit(0))), lambda g: g.rlike(r"^[ \t\r\n]*,[ \t\r\n]*$"))).otherwise(True)
    sound = (added.isin(0, 1) & (F.col("odd") == 0) & gaps & (end == 0) & ~F.col("open_string") & (F.col("base") > 0)
             & ~F.exists("parts", lambda x: F.contains(x, F.lit(EDGE))) & (F.coalesce("bad", F.lit(0)) == 0))
    shown = F.when(F.col("k") > 1, F.concat(F.col("parts").getItem(0), F.lit("{}"), F.element_at("parts", -1))).otherwise(F.col("parts").getItem(0))
    docs = docs.select("file", "size", sound.alias("sound"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("messages", F.lit(0)).alias("messages"),
                       "first", "base", shown.alias("shown"))
    return docs, records


def _sizes(spark: SparkSession, path, over: int) -> DataFrame:
    """file, size of the files above ``over`` bytes, from their listing."""
    listed = spark.read.format("binaryFile").load(path).where(F.col("length") > over)
    return listed.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"))


def any_above(spark: SparkSession, path, over: int) -> bool:
    return not _sizes(spark, path, over).limit(1).isEmpty()
