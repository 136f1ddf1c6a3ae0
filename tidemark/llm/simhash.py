"""SimHash near-dedup with BK-trees.

1. Each text becomes a 64-bit fingerprint of its word shingles (one Arrow pass).
2. Equal fingerprints are one node, over partial aggregates.
3. Two fingerprints within ``radius`` bits agree on at least one of ``radius + 1``
   disjoint bit blocks, so a *shard* -- all fingerprints with the same value in the
   same block -- holds both ends of every link.  Each shard is a BK-tree: children
   keyed by integer Hamming distance to the parent; a query follows only edges
   within the radius of its own distance.  A member queries the tree as it is
   inserted and is united with what it finds, and the shard emits one edge per
   member to its local root, so a dense group of n copies gives n edges, not pairs.
   Shards above ``SHARD_LIMIT`` are cut again by the same rule over the bits that are
   still free, level after level, so a hot block value is no single task.
4. Components of the edges: smallest label, by alternating star contraction.

The trees travel inside the tasks that hold the shard instead of a broadcast from
the driver: a broadcast would grow with the corpus.

Cases: null and empty texts have no shingle and fingerprint zero, linked like any
other; rows with the same id are rows of their own; a null id is the largest; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import load, stored, text_slices, word_bounds
from tidemark.llm.components import smallest_labels

SHINGLE = 3
RADIUS = 2
BITS = 64
SHARD_LIMIT = 20_000
LEVELS = 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_LANE = np.uint64(0x0101010101010101)


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per row, the bits set in over half of its hashes.  Eight counters of a byte
    share a word; no group of a sum has more than 255 hashes."""
    rows = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint64)
    if not len(rows):
        return out
    ends = np.cumsum(counts)
    begins = ends - counts
    per = -(-counts[rows] // 255)
    group_row = np.repeat(np.arange(len(rows)), per)
    step = np.arange(len(group_row)) - np.repeat(np.cumsum(per) - per, per)
    cuts = begins[rows][group_row] + 255 * step
    firsts = np.cumsum(per) - per
    need = counts[rows][:, None]
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANE, cuts)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), firsts, axis=0)
        bits = ((2 * ones > need).astype(np.uint64) << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(k)))
        out[rows] |= np.bitwise_or.reduce(bits, axis=1)
    return out


def fingerprints_of(data: np.ndarray, offs: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints of the rows of a slice of text bytes."""
    data = _LOWER[data]
    starts, ends, first = word_bounds(data, offs)
    if not len(starts):
        return np.zeros(len(offs) - 1, np.uint64)
    # words joined by one space: every shingle is then one run of bytes
    size = ends - starts
    at = np.cumsum(size + 1) - (size + 1)
    joined = np.full(int(size.sum() + len(size)), 0x20, np.uint8)
    joined[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = data[
        np.arange(int(size.sum())) + np.repeat(starts - (np.cumsum(size) - size), size)]
    words = np.diff(first)
    counts = np.where(words == 0, 0, np.maximum(words - shingle + 1, 1))
    row = np.repeat(np.arange(len(words)), counts)
    lead = first[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    tail = np.minimum(lead + shingle, first[1:][row]) - 1
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[a:b], 42) for a, b in zip(at[lead].tolist(), (at[tail] + size[tail]).tolist())),
                         np.uint64, len(lead))
    return _majority(hashes, counts)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
                 text_key: bool = False) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed long), and a hash of the text if asked for."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in text_slices(batches, 0):
            fp = pa.array(fingerprints_of(data, offs, shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([*part.columns[1:], fp], [*part.schema.names[1:], "fp"])

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"),
                       *[F.xxhash64(F.col(text_col).cast("string")).alias("text_key")] * text_key)
    return rows.mapInArrow(work, "doc_id long, " + "text_key long, " * text_key + "fp long")


def _blocks(free: list[int], n: int) -> list[list[int]]:
    """The free bits, lowest first, in n runs of about equal length."""
    cut = [round(i * len(free) / n) for i in range(n + 1)]
    return [free[a:b] for a, b in zip(cut, cut[1:])]


def _masks(radius: int) -> dict[str, tuple[int, dict[str, int]]]:
    """Shard kinds: name -> (mask of its fixed bits, kinds it is cut into)."""
    out: dict = {}

    def grow(name: str, fixed: int, level: int) -> dict[str, int]:
        kinds = {}
        for i, bits in enumerate(_blocks([b for b in range(BITS) if not fixed >> b & 1], radius + 1)):
            mask = fixed | sum(1 << b for b in bits)
            kinds[f"{name}{i}"] = mask
            out[f"{name}{i}"] = (mask, grow(f"{name}{i}", mask, level + 1) if level < LEVELS else {})
        return kinds

    out[""] = (0, grow("", 0, 1))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shards(nodes: DataFrame, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """kind, value, fp, id: every fingerprint in each of its shards, hot shards cut
    again.  A shard of one member holds no link and may be dropped by the reader."""
    masks = _masks(radius)

    def members(rows: DataFrame, kinds: dict[str, int]) -> DataFrame:
        each = [F.struct(F.lit(k).alias("kind"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value")) for k, m in kinds.items()]
        return rows.select("id", "fp", F.explode(F.array(*each)).alias("s")).select("id", "fp", "s.kind", "s.value")

    rows, out = members(nodes, masks[""][1]), None
    for level in range(1, LEVELS):
        hot = rows.groupBy("kind", "value").count().where(F.col("count") > limit).select("kind", "value")
        hot = stored(hot, "simhash_hot")
        cold = rows.join(hot, ["kind", "value"], "left_anti")
        out = cold if out is None else out.unionByName(cold)
        if hot.isEmpty():
            return out
        rest, rows = rows.join(hot, ["kind", "value"], "left_semi"), None
        for kind in [r[0] for r in hot.select("kind").distinct().collect()]:  # 3 kinds, then 9
            part = members(rest.where(F.col("kind") == kind).select("id", "fp"), masks[kind][1])
            rows = part if rows is None else rows.unionByName(part)
        rows = stored(rows, "simhash_cut")
    return out.unionByName(rows)


class BKTree:
    """Fingerprints under integer Hamming distance; children keyed by distance."""

    def __init__(self, radius: int):
        self.radius, self.codes, self.children = radius, [], []

    def add(self, code: int) -> list[int]:
        """Insert and return the numbers of the earlier members within the radius."""
        me, r = len(self.codes), self.radius
        codes, children, found = self.codes, self.children, []
        codes.append(code)
        children.append({})
        if not me:
            return found
        at = 0
        while True:  # the place of the new node
            d = (codes[at] ^ code).bit_count()
            nxt = children[at].setdefault(d, me)
            if nxt == me:
                break
            at = nxt
        todo = [0]
        while todo:
            at = todo.pop()
            if at == me:
                continue
            d = (codes[at] ^ code).bit_count()
            if d <= r:
                found.append(at)
            kids = children[at]
            if kids:
                todo += [k for e, k in kids.items() if -r <= e - d <= r]
        return found


def _shard_edges(codes: list[int], ids: list, radius: int) -> list[tuple]:
    """(id, smallest id of its local component) for the members that have links."""
    tree, root = BKTree(radius), list(range(len(codes)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, code in enumerate(codes):
        for j in tree.add(code):
            a, b = top(i), top(j)
            if a != b:
                root[max(a, b)] = min(a, b)
    # members come in ascending id: the local root is the smallest
    return [(ids[i], ids[top(i)]) for i in range(len(codes)) if top(i) != i]


def links(nodes: DataFrame, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """a, b: star edges whose components are those of all links within the radius."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def edges(table: pa.Table) -> pa.RecordBatch:
            value, fp, ids = (table.column(c).to_numpy() for c in ("value", "fp", "id"))
            kind = table.column("kind").combine_chunks().dictionary_encode()
            kind = (kind.combine_chunks() if isinstance(kind, pa.ChunkedArray) else kind).indices.to_numpy()
            new = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (kind[1:] != kind[:-1])]))
            stop = np.append(new[1:], len(value))
            pairs: list[tuple] = []
            for a, b in zip(new[stop - new > 1].tolist(), stop[stop - new > 1].tolist()):
                pairs += _shard_edges(fp[a:b].view(np.uint64).tolist(), ids[a:b].tolist(), radius)
            x, y = zip(*pairs) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            kind, value = table.column("kind"), table.column("value").to_numpy()
            same = (value == value[-1]) & pa.compute.equal(kind, kind[len(kind) - 1]).to_numpy()
            done = len(value) - int(np.argmin(same[::-1])) if not same.all() else 0
            if done:  # all shards but the last one, which may go on
                yield edges(table.slice(0, done))
                held = table.slice(done).to_batches()
        if held:
            yield edges(pa.Table.from_batches(held))

    placed = shards(nodes, radius, limit).repartition("kind", "value").sortWithinPartitions("kind", "value", "id")
    return placed.select("kind", "value", "fp", "id").mapInArrow(work, "a long, b long")


def _marked(docs: DataFrame, shingle: int, id_col: str, text_col: str, text_key: bool = False) -> DataFrame:
    rows = fingerprints(docs, shingle, id_col, text_col, text_key)
    return stored(rows, "simhash_marks")


def _roots(marks: DataFrame, radius: int, limit: int) -> DataFrame:
    """fp, root: the smallest fingerprint of each fingerprint's component."""
    nodes = stored(marks.select(F.col("fp").alias("id"), "fp").distinct(), "simhash_nodes")
    edges = stored(links(nodes, radius, limit).distinct(), "simhash_edges")
    return nodes.join(smallest_labels(edges), "id", "left").select("fp", F.coalesce("label", "id").alias("root"))


def near_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id",
                text_col: str = "text", limit: int = SHARD_LIMIT) -> DataFrame:
    """doc_id, fp, component_id for every row of ``docs``."""
    marks = _marked(docs, shingle, id_col, text_col)
    roots = stored(_roots(marks, radius, limit), "simhash_roots")
    least = marks.groupBy("fp").agg(F.min("doc_id").alias("id")).join(roots, "fp")
    group = least.groupBy("root").agg(F.min("id").alias("component_id"))
    top = stored(roots.join(group, "root").select("fp", "component_id"), "simhash_groups")
    # a frequent fingerprint is a skewed key of this join; its partition is split at run time
    return marks.join(top, "fp", "left").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id",
                text_col: str = "text", limit: int = SHARD_LIMIT) -> DataFrame:
    """The rows of ``docs`` with one row of each group: that with the smallest id (null
    last); all columns unchanged."""
    marks = _marked(docs, shingle, id_col, text_col, text_key=True)
    roots = _roots(marks, radius, limit)
    alike = marks.groupBy("fp", "doc_id", "text_key").count().join(roots, "fp")
    order = F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "text_key")
    best = alike.groupBy("root").agg(F.min(order).alias("least"), F.min_by("count", order).alias("rows"))
    best = stored(best.select(F.col("least.doc_id").alias("best_id"), F.col("least.text_key").alias("best_key"), F.col("rows").alias("best_rows")), "simhash_best")
    met = F.col("best_id").eqNullSafe(docs[id_col].cast("long")) & (F.col("best_key") == F.xxhash64(docs[text_col].cast("string")))
    kept = docs.join(best.where("best_rows = 1"), met, "left_semi")
    twice = best.where("best_rows > 1")
    if not twice.isEmpty():  # one row of those alike in id and text
        kept = kept.unionByName(docs.join(twice, met).dropDuplicates(["best_id", "best_key"]).select(*docs.columns))
    return kept


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_groups(load(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
