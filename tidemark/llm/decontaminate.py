"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is found in a document if at least ``threshold`` of the item's distinct word
shingles occur in the document.  Short items in long documents have a tiny Jaccard
similarity, so both sides are partitioned by size: items by the power of two of
their shingle count, and for each class every document is cut into windows of about
four times the smallest size of the class, half overlapping.  Inside a window of a class
the Jaccard similarity of a contained item is at least 0.19, whatever the length of
the document, and shingles scattered over a document meet as often in sum.  Bands
have one row: a window is a candidate if one of ``PERMUTATIONS`` minima equals the
item's.  At 0.19 all 64 miss with probability 2e-6.

Candidates are verified in the same task against the item's exact shingles as text.

Items are the stated query set: they are dealt into blocks of at most
``BLOCK_BYTES`` of text, and each block in turn is broadcast over all documents.

An item below ``shingle`` words has its whole word sequence as its only shingle; documents
are shingled at that length too, so it is found wherever it stands (its minimum is the
shingle itself).

Words are runs of letters, digits and combining marks of any script, after lower-casing, so
neither case nor punctuation, typographic or not, hides a copy.  Cases: null and empty
texts have no shingle and match nothing; alike items all match; rows with one id are judged
each by itself; empty tables give no match; other columns stay untouched in
``clean_rows``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import gram_hashes, load, span_hashes, text_slices, within_rows, word_bounds, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
PERMUTATIONS = 64
BLOCK_BYTES = 4 << 20
_WORDS = np.zeros(256, bool)
_WORDS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_RNG = np.random.Generator(np.random.PCG64(7))
_FLIP = _RNG.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64)
_FACTOR = _RNG.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)


def folded(text: pa.Array) -> pa.Array:
    """Lower case, with a space for everything that is no part of a word."""
    return pc.replace_substring_regex(pc.utf8_lower(text.cast(pa.string()).fill_null("")), r"[^\p{L}\p{N}\p{M}]+", " ")


def shingles_of(data: bytes, k: int = SHINGLE) -> set[bytes]:
    """The distinct shingles of one folded text, as text."""
    raw = np.frombuffer(data, np.uint8)
    words = bytes(np.where(_WORDS[raw], raw, 0x20).astype(np.uint8)).split()
    return {b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def shingle_hashes(data: np.ndarray, offs: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of a slice of folded texts, and each row's first one."""
    starts, ends, first = word_bounds(data, offs, _WORDS)
    words = word_hashes(data, starts, ends)
    count = np.diff(first)
    out = np.maximum(count - k + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(out)])
    lead = np.repeat(first[:-1] - at[:-1], out) + np.arange(at[-1])
    grams = gram_hashes(words, k)
    hashes = np.zeros(at[-1], np.uint64)
    whole = np.repeat(count >= k, out)
    hashes[whole] = grams[lead[whole]]
    short = np.flatnonzero((count > 0) & (count < k))
    hashes[at[short]] = span_hashes(words, first[short], first[short + 1]) if len(short) else 0
    return hashes, at


class ItemIndex:
    """A block of items: exact shingles, and per size class and permutation the
    items by their minimum."""

    def __init__(self, items: list[tuple], k: int, threshold: float):
        self.k, self.threshold = k, threshold
        texts = folded(pa.array([t for _, t in items], pa.string()))
        alike: dict[frozenset, list] = defaultdict(list)
        short: dict[int, set[bytes]] = defaultdict(set)
        for (key, _), t in zip(items, texts.cast(pa.binary()).to_pylist()):
            s, n = shingles_of(t, k), len(t.split())
            if s:
                alike[frozenset(s)].append(key)
            if 0 < n < k:
                short[n] |= s
        self.shingles, self.keys = list(alike), list(alike.values())
        number = {next(iter(s)): n for n, s in enumerate(self.shingles) if len(s) == 1}
        #: For each word count below ``shingle``: hashes of the items of so many words, in order, and text -> item.
        self.short = {n: (np.unique(self._run_hashes(texts, n)), {x: number[x] for x in texts}) for n, texts in short.items()}
        self.classes: dict[int, list] = {}
        by_class = defaultdict(list)
        few = {n for _, numbers in self.short.values() for n in numbers.values()}
        for n, s in enumerate(self.shingles):
            if n not in few:
                by_class[len(s).bit_length() - 1].append(n)
        for c, members in by_class.items():
            least = np.empty((PERMUTATIONS, len(members)), np.uint64)
            for j, n in enumerate(members):
                text = b"\n".join(self.shingles[n])
                offs = np.cumsum([0, *(len(x) + 1 for x in self.shingles[n])])
                offs[-1] = len(text)
                h, _ = shingle_hashes(np.frombuffer(text, np.uint8), offs, k)
                least[:, j] = ((h[None, :] ^ _FLIP[:, None]) * _FACTOR[:, None]).min(axis=1)
            tables = []
            for p in range(PERMUTATIONS):
                order = np.argsort(least[p])
                hint = np.zeros(1 << 16, bool)
                hint[(least[p] & np.uint64(0xFFFF)).astype(np.int64)] = True
                tables.append((hint, least[p][order], np.array(members)[order]))
            self.classes[c] = tables

    @staticmethod
    def _run_hashes(texts: set[bytes], n: int) -> np.ndarray:
        """Hash of each text of n words."""
        data = b" ".join(sorted(texts))
        starts, ends, _ = word_bounds(np.frombuffer(data, np.uint8), np.array([0, len(data)]), _WORDS)
        return gram_hashes(word_hashes(np.frombuffer(data, np.uint8), starts, ends), n)[::n]

    def short_matches(self, data: np.ndarray, offs: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) of the items below ``shingle`` words that stand in a row."""
        out: set[tuple[int, int]] = set()
        if not self.short:
            return out
        starts, ends, first = word_bounds(data, offs, _WORDS)
        words = word_hashes(data, starts, ends)
        for n, (values, numbers) in self.short.items():
            at = np.flatnonzero(within_rows(first, len(words), n) & np.isin(gram_hashes(words, n), values))
            rows = np.searchsorted(first, at, side="right") - 1
            for row, i in zip(rows.tolist(), at.tolist()):
                item = numbers.get(b" ".join(data[a:b].tobytes() for a, b in zip(starts[i:i + n], ends[i:i + n])))
                if item is not None:
                    out.add((row, item))
        return out

    def candidates(self, hashes: np.ndarray, at: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) pairs with an equal minimum in some window of the item's class."""
        out: set[tuple[int, int]] = set()
        if not self.classes or not len(hashes):
            return out
        base = min(self.classes)
        unit = 2 << base  # shingles in the smallest block: an item of the class fits in it
        count = np.diff(at)
        blocks = -(-count // unit)
        first = np.concatenate([[0], np.cumsum(blocks)])
        row = np.repeat(np.arange(len(count)), blocks)
        inner = np.arange(first[-1]) - first[:-1][row]
        take = at[row][:, None] + np.minimum(inner[:, None] * unit + np.arange(unit), count[row][:, None] - 1)
        padded = hashes[take]  # the last block of a row repeats its last shingle
        plans = []
        for c, tables in self.classes.items():
            wide = 1 << (c - base)
            group = np.flatnonzero(inner % wide == 0)
            of = row[group]
            joins = np.zeros(len(group), bool)
            joins[:-1] = of[1:] == of[:-1]
            plans.append((tables, wide, group, of, joins))
        for p in range(PERMUTATIONS):
            least = ((padded ^ _FLIP[p]) * _FACTOR[p]).min(axis=1)
            for tables, wide, group, of, joins in plans:
                hint, values, members = tables[p]
                low = np.minimum.reduceat(least, group) if wide > 1 else least
                windows = low.copy()
                windows[:-1][joins[:-1]] = np.minimum(low[:-1], low[1:])[joins[:-1]]
                maybe = np.flatnonzero(hint[(windows & np.uint64(0xFFFF)).astype(np.int64)])
                if len(maybe):
                    a = np.searchsorted(values, windows[maybe], "left")
                    b = np.searchsorted(values, windows[maybe], "right")
                    for w, i, j in zip(maybe[b > a].tolist(), a[b > a].tolist(), b[b > a].tolist()):
                        out.update((int(of[w]), int(m)) for m in members[i:j])
        return out

    def matches(self, data: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item, shared shingles) of the verified candidates."""
        hashes, at = shingle_hashes(data, offs, self.k)
        found, sets = [], {}
        for row, item in sorted(self.candidates(hashes, at)):
            if row not in sets:
                sets = {row: shingles_of(data[offs[row]:offs[row + 1]].tobytes(), self.k)}
            shared = len(self.shingles[item] & sets[row])
            if shared >= self.threshold * len(self.shingles[item]) - 1e-9:
                found.append((row, item, shared))
        return found + [(row, item, 1) for row, item in sorted(self.short_matches(data, offs))]


def item_blocks(items: DataFrame, id_col: str, text_col: str, limit: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The query set in blocks of about ``limit`` bytes of text."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-2 * size // limit)) if size > limit else 1
    for i in range(n):
        block = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i) if n > 1 else rows
        yield [tuple(r) for r in block.collect()]


def _folded_slices(batches: Iterator[pa.RecordBatch], column: int):
    for part, _, _ in text_slices(batches, column):
        yield part, *next((d, o) for _, d, o in text_slices([pa.RecordBatch.from_arrays([folded(part.column(column))], ["t"])], 0, 1 << 62))


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE,
                    id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, shared, item_shingles, containment of every item found in a row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, shared long, item_shingles long, containment double"
    out = None
    for block in item_blocks(items, item_id, item_text, block_bytes):
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex(block, shingle, threshold))

        def work(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            x = index.value
            for part, data, offs in _folded_slices(batches, 1):
                hits = [(part.column(0)[row].as_py(), key, shared, len(x.shingles[item]), shared / len(x.shingles[item]))
                        for row, item, shared in x.matches(data, offs) for key in x.keys[item]]
                cols = list(zip(*hits)) if hits else [()] * 5
                kinds = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 ["doc_id", "item_id", "shared", "item_shingles", "containment"])

        found = rows.mapInArrow(work, schema)
        out = found if out is None else out.unionByName(found)
    return out


def clean_rows(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns unchanged."""
    at, out = docs.columns.index(text_col), docs
    for block in item_blocks(items, item_id, item_text, block_bytes):
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex(block, shingle, threshold))

        def work(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for part, data, offs in _folded_slices(batches, at):
                clean = np.ones(part.num_rows, bool)
                clean[[row for row, _, _ in index.value.matches(data, offs)]] = False
                yield part.filter(pa.array(clean))

        out = out.mapInArrow(work, docs.schema)
    return out


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


OP3_SQL = r"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}\p{M}]+') AS w FROM documents
  UNION ALL SELECT 'i', item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}\p{M}]+') FROM benchmark),
lengths AS (SELECT DISTINCT least(5, len(w)) AS k FROM words WHERE side = 'i' AND len(w) > 0),
shingles AS (
  SELECT DISTINCT side, id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT side, id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words JOIN lengths
        ON len(w) >= k AND (side = 'd' OR k = least(5, len(w))))),
sizes AS (SELECT id, count(*) AS n FROM shingles WHERE side = 'i' GROUP BY id),
met AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared
        FROM shingles i JOIN shingles d ON d.s = i.s AND d.k = i.k AND d.side = 'd' AND i.side = 'i' GROUP BY ALL)
SELECT doc_id, item_id, shared::BIGINT AS shared, n::BIGINT AS item_shingles, shared / n::DOUBLE AS containment
FROM met JOIN sizes ON item_id = id WHERE shared >= 0.8 * n - 1e-9
"""
