"""Spelling variants by a bit-sliced position index.

The vocabulary is dealt into shards of words of one length.  A shard's index holds one
bitset over its words per (position, letter).  A query word runs through it letter by
letter with two bitsets: the words that agree so far, and those that agree but for one
error.  Against words as long as itself the error is a replaced letter; against words
one longer or shorter the positions are shifted by one from the error on.  Each step is
a few operations on whole bitsets, so it treats all words of the shard at once.

Queries reach a shard sorted, and states of shared prefixes are kept, so only new
letters are worked through.  Words of a shard stand by falling count: the lowest bit of
a result is its most frequent word.  A shard has at most ``SHARD`` words and meets
``QUERIES`` query words at a time, whatever the length most words have.

Words, counts and the following of forms are SQL: counts are partial aggregates, and
forms are followed by doubling, as a form occurs at least twice as often as its word.

Cases: null and empty texts have no words; a null id enters the hash as an empty text;
repeated rows count each time; of near words with equal counts the smallest in code-point
order is the form; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import load, partitions_for, stored

LEAST_LENGTH = 5
LEAST_COUNT = 3
SLIP = 97
SHARD = 1 << 15
QUERIES = 1 << 16
LETTERS = "a-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOUND = "word string, near string, near_n long, n_near long"


class PositionIndex:
    """Bitsets over words of one length: bit j is word j."""

    def __init__(self, words: list[str]):
        self.words, self.length = words, len(words[0])
        self.all = (1 << len(words)) - 1
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.codes = np.ascontiguousarray(codes.reshape(len(words), self.length).T)
        self.sets: dict[tuple[int, str], int] = {}
        self.room = max(1024, (64 << 20) // (len(words) // 8 + 100))
        self.stacks: dict[int, tuple[str, list[tuple[int, int]]]] = {}

    def at(self, place: int, letter: str) -> int:
        """The words with this letter at this position."""
        if not 0 <= place < self.length:
            return 0
        got = self.sets.get((place, letter))
        if got is None:
            if len(self.sets) >= self.room:  # only with very long words
                self.sets.clear()
            got = int.from_bytes(np.packbits(self.codes[place] == ord(letter), bitorder="little").tobytes(), "little")
            self.sets[place, letter] = got
        return got

    def near(self, word: str) -> int:
        """The words that differ from ``word`` by exactly one letter."""
        shift = self.length - len(word)
        last, states = self.stacks.get(shift, ("", [(self.all, self.all if shift > 0 else 0)]))
        shared = 0
        for a, b in zip(last, word):
            if a != b:
                break
            shared += 1
        del states[shared + 1:]
        same, error = states[-1]
        for i in range(shared, len(word)):
            here = same & self.at(i, word[i])
            error &= self.at(i + shift, word[i])
            if shift == 0:
                error |= same ^ here  # agreed before, not here
            elif shift > 0:
                error |= here  # the next letter of the longer word is the added one
            else:
                error |= same  # this letter is the one left out
            same = here
            states.append((same, error))
        self.stacks[shift] = (word, states)
        return error


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, index words first: a row per query word with near words."""
    key, words, counts, index = None, [], [], None
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                          ["word", "near", "near_n", "n_near"])

    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        for length, shard, block, query, word, n in zip(*cols):
            if (length, shard, block) != key:
                key, words, counts, index = (length, shard, block), [], [], None
            if not query:
                words.append(word)
                counts.append(n)
                continue
            index = index or PositionIndex(words)
            hits = index.near(word)
            if hits:
                best = (hits & -hits).bit_length() - 1
                out.append((word, words[best], counts[best], hits.bit_count()))
        if len(out) > 10_000:
            yield flush()
    if out:
        yield flush()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the words of at least five letters that occur at least three times."""
    lower = F.translate(F.col(text_col).cast("string"), _UPPER, _LOWER)
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(lower, F.lit(f"([{LETTERS}]{{{LEAST_LENGTH},}})"), F.lit(1))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.char_length("run")).cast("int")
    slipped = F.concat(F.left("run", place), F.substr("run", place + 2))
    words = hashed.select(F.when(F.col("h") % SLIP == 0, slipped).otherwise(F.col("run")).alias("word"))
    return (words.where(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


def near_words(vocab: DataFrame) -> DataFrame:
    """word, form, form_n, n_near of the words that have a near word; ``form`` is the most
    frequent one, however often it occurs."""
    spark = vocab.sparkSession
    sized = vocab.select("word", "n", F.char_length("word").alias("own"))
    lengths = stored(sized.groupBy("own").agg(F.count("*").alias("size")), "spelling_lengths")
    around = (lengths.select("size", F.explode(F.array(*[F.col("own") + d for d in (-1, 0, 1)])).alias("own"))
              .groupBy("own").agg(F.sum("size").alias("asking")))
    up = lambda c, step: F.ceil(F.col(c) / step).cast("int")
    dealt = (lengths.join(around, "own").select(F.col("own").alias("length"), up("size", SHARD).alias("shards"), up("asking", QUERIES).alias("blocks")))
    number = lambda many: F.pmod(F.xxhash64("word"), F.col(many)).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.col(many) - 1))
    index = (sized.withColumn("length", F.col("own")).join(dealt, "length")
             .select("length", number("shards").alias("shard"), every("blocks").alias("block"), F.lit(False).alias("query"), "word", "n"))
    asked = (sized.withColumn("length", F.explode(F.array(*[F.col("own") + d for d in (-1, 0, 1)]))).join(dealt, "length")
             .select("length", every("shards").alias("shard"), number("blocks").alias("block"), F.lit(True).alias("query"), "word", "n"))
    key = ["length", "shard", "block"]
    order: list[Column] = [F.col("query"), F.when(~F.col("query"), -F.col("n")), F.col("word")]
    found = (index.unionByName(asked).repartition(partitions_for(spark), *key).sortWithinPartitions(*key, *order)
             .mapInArrow(_search, _FOUND))
    best = F.min(F.struct((-F.col("near_n")).alias("low"), "near"))
    return (found.groupBy("word").agg(best.alias("b"), F.sum("n_near").alias("n_near"))
            .select("word", F.col("b.near").alias("form"), (-F.col("b.low")).alias("form_n"), "n_near"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    vocab = stored(vocabulary(docs, id_col, text_col), "spelling_words")
    kept = F.col("form_n") >= 2 * F.col("n")
    rows = (vocab.join(near_words(vocab), "word", "left")
            .select("word", F.when(kept, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                    F.when(kept, F.col("form_n")).alias("form_n")))
    rows = stored(rows, "spelling_forms")
    return rows.join(roots(rows), "word", "left").withColumn("root", F.coalesce("root", "word")).select(
        "word", "form", "root", "n", "n_near", "form_n")


def roots(rows: DataFrame) -> DataFrame:
    """word, root of every word that has a form.  Each round doubles the steps taken;
    counts double along a chain, so there are few rounds."""
    chain = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(chain.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                      "spelling_roots")
        chain = step.select("word", "root")
        if step.where("moved").isEmpty():
            return chain


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(load(spark, sf_dir, "documents"))
