"""Substring dedup with a column-wise built Burrows-Wheeler transform.

A byte string of ``window`` bytes goes where it also starts earlier, in a document
before or further up in its own.

*Dealing.*  Every window is filed under its anchor, the least-hashed run of ``ANCHOR``
bytes in it; neighbouring windows with one anchor are a *piece* of at most
2 ``window`` - ``ANCHOR`` bytes.  Equal windows have equal anchors, so texts are only
compared among pieces of one anchor.  The first row with a piece owns it, and all
windows of its other copies go; that is a minimum per piece, so a passage in a third of
all rows is one partial aggregate a task.  Anchors with one piece text need no more.

*Columns.*  The owned pieces of the other anchors are brought together by anchor, whole
anchors at a time up to ``BATCH`` bytes.  Each batch is a collection of texts whose
transform is built from their last column on: each round inserts one symbol per text.
The symbol before a suffix has its place by the symbols before it in the transform
(last-to-first mapping), and the common prefix of two new neighbours is one more than
the least common prefix between the places they come from.  A round reads the arrays of
the last one in sequence and writes those of the next; they are arrays in memory, bounded
by the batch, where a single machine would hold files.  Runs of suffixes with ``window``
common bytes are the repeated windows.

*Frequent anchors.*  Pieces of an anchor with over ``MANY`` piece texts, say in a line
that stands in ever other surroundings, are dealt out again by the hash of each window,
whose first row is a minimum as above.

Pieces and the windows of frequent anchors are compared by two 64-bit hashes together,
all else byte by byte.

Cases: null and empty texts have no bytes; texts below ``window`` bytes lose nothing; a
null id is later than all others; rows with one id are ordered by their text's hash, and
of wholly equal rows one comes first; texts of any length are worked through in steps;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import _powers, load, mix, numbered, partitions_for, released, stored, text_slices

WINDOW = 100
ANCHOR = 40
BATCH = 1 << 18
MANY = 2048
STEP = 1 << 21
SLICE = 1 << 17  # its arrays of 64-bit hashes stay in a core's cache
END = 255  # no byte of UTF-8
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The pieces of a slice of texts: anchor, hash of the text, first byte, number of
    windows, row."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, window: int):
        self.window, self.data, self.offs = window, data, offs
        parts = [self._step(lo) for lo in range(0, max(1, len(data)), STEP)]
        self.anchor, self.text, self.start, self.count = (np.concatenate(c) for c in zip(*parts))
        self.row = np.searchsorted(offs, self.start, side="right") - 1

    def _step(self, lo: int) -> tuple[np.ndarray, ...]:
        """The windows that start in one step of the slice."""
        window, m = self.window, min(ANCHOR, self.window)
        hi = min(len(self.data), lo + STEP + window - 1)
        n, count = hi - lo, hi - lo - window + 1
        if count <= 0:
            return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
        up, down = _powers(n + 1)
        run = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:n], out=run[1:])
        grams = mix((run[m:] - run[:-m]) * down[:n - m + 1])
        bits = np.uint64(22)
        least = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)  # ties: the leftmost
        span, width = window - m + 1, 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
        inside = np.ones(count, bool)
        for end in self.offs[1:] - lo:
            if 0 < end < n:
                inside[max(0, end - window + 1):end] = False
        at = np.flatnonzero(inside)
        place = (least[at] & np.uint64((1 << 22) - 1)).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
        opens = np.flatnonzero(new)
        first, size = at[opens], np.diff(np.append(opens, len(at)))
        until = first + size - 1 + window
        text = mix((run[until] - run[first]) * down[first] + size.astype(np.uint64) * _ODD)
        return grams[place[opens]], text, first + lo, size

    def first_in_row(self) -> np.ndarray:
        """Whether a piece is the first of its text in its row."""
        key = mix(self.text + self.anchor * _ODD) + self.row.astype(np.uint64) * _ODD
        out = np.zeros(len(key), bool)
        out[np.unique(key, return_index=True)[1]] = True
        return out

    def listed(self, lists: pa.ListArray) -> np.ndarray:
        """Whether a piece's text is in the list of its row."""
        flat, size = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.asarray(lists.value_lengths().fill_null(0))
        of = np.repeat(np.arange(len(size)), size).astype(np.uint64)
        return np.isin(self.text + self.row.astype(np.uint64) * _ODD, flat + of * _ODD)

    def bytes_of(self, i: int) -> bytes:
        a = self.start[i]
        return self.data[a:a + self.count[i] - 1 + self.window].tobytes()


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def piece_rows(rows: DataFrame, window: int) -> DataFrame:
    """anchor, piece, ord: each piece text of each row once."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in text_slices(batches, 1, SLICE):
            p = Pieces(data, offs, window)
            own = p.first_in_row()
            yield pa.RecordBatch.from_arrays([_long(p.anchor[own]), _long(p.text[own]), part.column(0).take(pa.array(p.row[own]))],
                                             ["anchor", "piece", "ord"])

    return rows.select("ord", "text").mapInArrow(work, "anchor long, piece long, ord long")


def asked_texts(rows: DataFrame, window: int) -> DataFrame:
    """What the comparison needs of the pieces in the rows' lists: anchor, ord, start and
    bytes of each piece in ``asked``; of those in ``frequent`` anchor, ord, start and hash
    ``win`` of every window, and whether the row has the window before (``again``)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "ord", "start", "bytes", "win", "again"]
        for part, data, offs in text_slices(batches, 1, SLICE):
            p = Pieces(data, offs, window)
            first = p.first_in_row()
            which = np.flatnonzero(first & p.listed(part.column(2)))
            n = len(which)
            yield pa.RecordBatch.from_arrays(
                [_long(p.anchor[which]), part.column(0).take(pa.array(p.row[which])), _long(p.start[which] - offs[p.row[which]]),
                 pa.array([p.bytes_of(i) for i in which], pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_())], names)
            which = np.flatnonzero(first & p.listed(part.column(3)))
            if not len(which):
                continue
            row, count = np.repeat(p.row[which], p.count[which]), p.count[which]
            place = np.repeat(p.start[which] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            up, down = _powers(len(data) + 1)
            run = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=run[1:])
            win = mix((run[place + window] - run[place]) * down[place] + _ODD)
            again = np.ones(len(win), bool)
            again[np.unique(win + row.astype(np.uint64) * _ODD, return_index=True)[1]] = False
            yield pa.RecordBatch.from_arrays([_long(np.repeat(p.anchor[which], count)), part.column(0).take(pa.array(row)), _long(place - offs[row]),
                                              pa.nulls(len(win), pa.binary()), _long(win), pa.array(again)], names)

    return rows.select("ord", "text", "asked", "frequent").mapInArrow(work, "anchor long, ord long, start long, bytes binary, win long, again boolean")


def _least_between(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(values[a..b]) for each pair, both ends included."""
    level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
    table = [values]
    for j in range(int(level.max(initial=0))):
        last, width = table[-1], 1 << j
        table.append(np.minimum(last[:-width], last[width:]))
    out = np.empty(len(a), values.dtype)
    for j, mins in enumerate(table):
        of = np.flatnonzero(level == j)
        if len(of):
            out[of] = np.minimum(mins[a[of]], mins[b[of] - (1 << j) + 1])
    return out


def column_bwt(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of a collection of texts, with the common prefix of each
    suffix with the one before, its text and its first byte.  The ends of the texts sort
    before all bytes, in the order of the texts, and have nothing in common."""
    k, size = len(texts), np.array([len(t) for t in texts], np.int64)
    flat, begin = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size

    def before(of: np.ndarray, left: np.ndarray) -> np.ndarray:
        return np.where(left > 0, flat[np.maximum(begin[of] + left - 1, 0)], END).astype(np.uint8)

    bwt, lcp = before(np.arange(k), size), np.zeros(k, np.uint8 if size.max() < 256 else np.int64)
    live, left = np.flatnonzero(size > 0), size.copy()
    place = live
    while len(live):
        order = np.argsort(bwt, kind="stable")  # where the symbols of all suffixes but the ends come from
        mark = np.zeros(len(bwt), bool)
        mark[place] = True
        come = np.flatnonzero(mark[order])  # the new suffixes among them
        of = np.empty(len(bwt), np.int32)
        of[place] = np.arange(len(place))
        who = of[order[come]]
        live, place = live[who], place[who]
        new = np.zeros(len(bwt) + 1, bool)
        new[come] = new[come + 1] = True
        met = np.flatnonzero(new[:len(bwt) - np.count_nonzero(bwt == END)])  # new, or the one before is
        here, last = order[met], order[np.maximum(met - 1, 0)]
        alike = np.flatnonzero((met > 0) & (bwt[here] == bwt[last]))
        common = np.zeros(len(met), lcp.dtype)
        common[alike] = 1 + _least_between(lcp, last[alike] + 1, here[alike])
        left[live] -= 1
        old = np.ones(len(bwt) + len(live), bool)
        old[k + come] = False

        def merged(past: np.ndarray, fresh: np.ndarray | int) -> np.ndarray:
            out = np.empty(len(old), past.dtype)
            out[old] = past
            out[k + come] = fresh
            return out

        bwt, lcp = merged(bwt, before(live, left[live])), merged(lcp, 0)
        lcp[k + met] = common
        on = left[live] > 0
        live, place = live[on], (k + come)[on]
    # which suffix stands where: from the ends of the texts backwards through the transform
    back = np.empty(len(bwt), np.int64)
    back[np.argsort(bwt, kind="stable")] = k + np.arange(len(bwt))
    text, at = np.empty(len(bwt), np.int32), np.empty(len(bwt), np.int32)
    live, left = np.arange(k), size.copy()
    place = live
    while len(live):
        text[place], at[place] = live, left[live]
        on = left[live] > 0
        live, place = live[on], back[place[on]]
        left[live] -= 1
    return bwt, lcp, text, at


def later_windows(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, first byte) of every window that a text before in the list has as well;
    no text has a window twice."""
    _, lcp, text, at = column_bwt(texts)
    same = lcp >= window
    group = np.cumsum(~same)
    some = np.flatnonzero(same | np.append(same[1:], False))
    if not len(some):
        return text[:0], at[:0]
    opens = np.flatnonzero(np.diff(group[some], prepend=-1))
    first = np.minimum.reduceat(text[some], opens)
    late = some[text[some] != np.repeat(first, np.diff(np.append(opens, len(some))))]
    late = late[np.lexsort((at[late], text[late]))]
    return text[late], at[late]


def boundary_marks(pieces: DataFrame, window: int, batch_bytes: int) -> DataFrame:
    """ord, start, count: runs of windows of the pieces that an earlier piece has."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def settled() -> pa.RecordBatch:
            text, at = later_windows([h[3] for h in held], window)
            opens = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(at, prepend=-9) != 1))
            count = np.diff(np.append(opens, len(text)))
            of = text[opens]
            return pa.RecordBatch.from_arrays([pa.array([held[i][1] for i in of], pa.int64()), pa.array([held[i][2] + int(a) for i, a in zip(of, at[opens])], pa.int64()),
                                               _long(count.astype(np.int64))], ["ord", "start", "count"])

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if size >= batch_bytes and row[0] != held[-1][0]:
                    yield settled()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield settled()

    dealt = pieces.repartition(partitions_for(pieces.sparkSession), "anchor").sortWithinPartitions("anchor", "ord", "start")
    return dealt.select("anchor", "ord", "start", "bytes").mapInArrow(work, "ord long, start long, count long")


def _cut(rows: DataFrame, window: int) -> DataFrame:
    kept = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                      ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in text_slices(batches, 1, SLICE):
            p = Pieces(data, offs, window)
            copied = np.flatnonzero(~p.first_in_row() | p.listed(part.column(2)))
            marks, of = part.column(3), np.repeat(np.arange(part.num_rows), np.asarray(part.column(3).value_lengths().fill_null(0)))
            flat = marks.flatten()
            start, count = (flat.field(j).to_numpy(zero_copy_only=False).astype(np.int64) for j in range(2))
            opens = np.concatenate([p.start[copied], start + offs[of]])
            step = np.zeros(len(data) + 1, np.int32)
            np.add.at(step, opens, 1)
            np.add.at(step, opens + np.concatenate([p.count[copied], count]) - 1 + window, -1)
            gone, raw, out = np.cumsum(step[:-1]) > 0, data.tobytes(), []
            for i, key in enumerate(part.column(4).to_pylist()):
                a, b = int(offs[i]), int(offs[i + 1])
                g = gone[a:b]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8)))
                out.append((key, b - a, int(g.sum()), edge.reshape(-1, 2).tolist(), data[a:b][~g].tobytes() if len(edge) else raw[a:b]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), kept)], schema=kept)

    return rows.select("ord", "text", "copied", "marks", "doc_id").mapInArrow(
        work, "doc_id long, n_bytes long, n_removed long, spans array<array<long>>, kept binary")


def without_repeats(docs: DataFrame, window: int = WINDOW, many: int = MANY, batch_bytes: int = BATCH,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, spans, kept per row of ``docs``: the spans of bytes
    (start, end) removed, and the other bytes joined."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = numbered(rows, [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")], "sa_documents")
    rows = rows.select((F.shiftleft(F.col("part").cast("long"), 33) + F.col("pos")).alias("ord"), "doc_id", "text")
    pieces = stored(piece_rows(rows, window), "sa_pieces")
    known = pieces.groupBy("anchor").agg(F.min("ord").alias("earliest"), F.max("ord").alias("latest"), F.min("piece").alias("least"), F.max("piece").alias("most"))
    known = stored(known.where("earliest < latest OR least <> most").select("anchor", "earliest", (F.col("least") != F.col("most")).alias("mixed")), "sa_anchors")
    # a frequent anchor or piece is a skewed key of these joins, whose partition is split at run time
    shared = stored(pieces.join(known, "anchor").where("mixed OR earliest < ord").select("anchor", "piece", "ord", "mixed"), "sa_shared")
    released(pieces, known)
    mixed = shared.where("mixed")
    owners = stored(mixed.groupBy("anchor", "piece").agg(F.min("ord").alias("owner")), "sa_owners")
    copied = shared.where("NOT mixed").select("ord", "piece").unionByName(
        mixed.join(owners, ["anchor", "piece"]).where("owner < ord").select("ord", "piece"))
    texts = owners.groupBy("anchor").agg(F.count("*").alias("n")).select("anchor", (F.col("n") > many).alias("many"))
    asked = (owners.join(texts, "anchor").groupBy(F.col("owner").alias("ord"))
             .agg(F.collect_set(F.when(~F.col("many"), F.col("piece"))).alias("asked"), F.collect_set(F.when(F.col("many"), F.col("piece"))).alias("frequent")))
    found = stored(asked_texts(rows.join(asked, "ord"), window), "sa_texts")
    marks = boundary_marks(found.where("bytes IS NOT NULL"), window, batch_bytes)
    single = found.where("win IS NOT NULL").select("win", "anchor", "ord", "start", "again")
    first = single.groupBy("win", "anchor").agg(F.min("ord").alias("first"))
    late = single.join(first, ["win", "anchor"]).where("again OR first < ord").select("ord", "start", F.lit(1).cast("long").alias("count"))
    nothing = F.lit(None).cast("long")
    told = (copied.select("ord", "piece", nothing.alias("start"), nothing.alias("count"))
            .unionByName(marks.unionByName(late).select("ord", nothing.alias("piece"), "start", "count")))
    told = told.groupBy("ord").agg(F.collect_set("piece").alias("copied"), F.collect_list(F.when(F.col("start").isNotNull(), F.struct("start", "count"))).alias("marks"))
    told = stored(told, "sa_told")
    released(shared, owners, found)
    return _cut(rows.join(told, "ord", "left"), window)


def op12_suffix_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
