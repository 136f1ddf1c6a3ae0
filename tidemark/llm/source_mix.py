"""Mixing sources to target weights.

Every source gets a share of a total budget by its weight, at most ``max_epochs``
times its own size; what a full source cannot take is shared again by weight.  Its
documents are put in a random order that depends only on a hash of the id, sizes
are summed along that order over all partitions, and the source is cut at exactly
its budget: whole epochs first, then the documents of one more epoch up to the cut,
the last of them in part.

The order is a range partitioning by (source, hash, id): a source with a third of
all rows is dealt over a third of the partitions.  Only sums per partition and
source meet again, never the rows of a source.

Cases: null text has size 0; null source is a source of its own, last in order;
null ids and repeated rows are rows like any other (rows with one id and one text
are alike, so their order does not show); sources of size 0 have target 0; an empty
table gives an empty result; other columns stay untouched in ``mixed_rows``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, load, numbered, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2


def words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
                   max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """source, source_size, weight, target from one row (source, source_size) per source.

    The level -- budget per unit of weight -- rises until no target is above its cap:
    each round sums what full sources hold and shares the rest.  Sources stay in a
    table; a round brings three numbers to the driver.
    """
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()], "mix_sources")
    counts = ranked.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("before") + F.col("pos")) % len(weights) + 1).cast("int"))
    table = stored(ranked.join(F.broadcast(before), "part").select("source", "source_size", weight.alias("weight")), "mix_weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    budget, cap, level, full = share * total, F.col("source_size") * float(max_epochs), 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) >= cap
        n, held, rest = table.agg(F.count_if(over), F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first()
        if n == full or not rest:
            level = level if rest else math.inf
            break
        full, level = n, (budget - (held or 0.0)) / rest
    return table.select("source", "source_size", "weight",
                        F.least(F.col("weight") * F.lit(level), cap).alias("target") if math.isfinite(level) else cap.alias("target"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
        seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, text_key, size, source, source_size, target, taken: one row per row of ``docs``.
    ``taken``: words the mix takes of it, repeats counted."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       words(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("text_key"))
    rows = stored(rows, "mix_sizes")
    order = [F.col("source").asc_nulls_last(), F.xxhash64(F.lit(seed), "doc_id"), F.col("doc_id"), F.col("text_key"), F.col("size")]
    placed = numbered(rows, order, "mix_order")
    held = placed.groupBy("part", "source").agg(F.sum("size").alias("held"))
    held = stored(held, "mix_held")
    targets = source_targets(held.groupBy("source").agg(F.sum("held").alias("source_size")), weights, share, max_epochs)
    # sums of (part, source): a row per partition and a row more per source
    ahead = Window.partitionBy("source").orderBy("part")
    starts = held.select("part", "source", (F.sum("held").over(ahead) - F.col("held")).alias("start"))
    starts = starts.join(targets, starts["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    inside = Window.partitionBy("part", "source").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumn("before", F.sum("size").over(inside) - F.col("size"))
    out = local.join(starts.withColumnRenamed("source", "_source"),
                     (F.col("_source").eqNullSafe(F.col("source"))) & (starts["part"] == local["part"])).drop("_source")
    budget = F.floor(F.col("target"))
    epochs = F.floor(budget / F.greatest(F.col("source_size"), F.lit(1)))
    left = budget - epochs * F.col("source_size") - (F.col("start") + F.col("before"))
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return out.select("doc_id", "text_key", "size", "source", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               length_col: str | None = None, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them: whole copies, then one cut
    after the words still due.  All columns stay; only the text of a cut row changes
    (its words, joined by one space), and its length if a column for it is named.  A row without words stays once.  Rows alike in
    id, text and source share what was taken of them in equal parts, rounded down."""
    plan = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    plan = (plan.groupBy("doc_id", "text_key", "source")
            .agg(F.first("size").alias("size"), F.floor(F.sum("taken") / F.count("*")).alias("due")))
    plan = plan.select(*[F.col(c).alias(f"mix_{c}") for c in plan.columns])
    met = docs.join(plan, F.col("mix_doc_id").eqNullSafe(docs[id_col].cast("long"))
                    & (F.col("mix_text_key") == F.xxhash64(docs[text_col]))
                    & F.col("mix_source").eqNullSafe(docs[source_col].cast("string")))
    whole = F.floor(F.col("mix_due") / F.greatest(F.col("mix_size"), F.lit(1)))
    rest = F.col("mix_due") - whole * F.col("mix_size")
    none = F.array().cast("array<bigint>")
    copies = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")), F.when(rest > 0, F.array(rest)).otherwise(none))
    copies = F.when(F.col("mix_size") == 0, F.array(F.lit(-1).cast("long"))).otherwise(copies)
    head = F.slice(F.regexp_extract_all(docs[text_col], F.lit(WORD), F.lit(0)), F.lit(1), F.col("mix_cut").cast("int"))
    text = F.when(F.col("mix_cut") < 0, docs[text_col]).otherwise(F.array_join(head, " "))
    changed = {text_col: text}
    if length_col:
        changed[length_col] = F.when(F.col("mix_cut") < 0, docs[length_col]).otherwise(F.length(text))
    return met.withColumn("mix_cut", F.explode(copies)).select(*[changed.get(c, docs[c]).alias(c) for c in docs.columns])


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")
