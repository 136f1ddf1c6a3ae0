"""Exact dedup by content sort.

Rows are range-partitioned by sampled splitters over (leading characters, SHA-256
of the normalised text, id), so equal texts are neighbours and a large group of
copies is dealt over as many partitions as it needs; inside a partition Spark's
external sort orders them, and each row's whole normalised text is compared with
its neighbour's.  A run that reaches over partition borders is joined from one
summary row per border: at most two per partition, whatever the data.

Cases: null text counts as empty; a null id sorts below every other; rows with the
same id and text are copies of each other; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import load, partitions_for, stored

LEAD = 32
_RUNS = "doc_id long, text_sha256 string, keep_id long, group_size long, first boolean, kept boolean, part int, edge int"


def same(text: Column) -> Column:
    """Normalisation that changes nothing."""
    return text


def folded(text: Column) -> Column:
    """Normalisation for looser copies: case and runs of white space do not count."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _runs() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs of equal neighbours in one sorted partition.  ``edge``: 0 for a run that
    ends inside, 1 for the partition's first run, 2 for its last, 3 for both."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64()),
                        ("first", pa.bool_()), ("kept", pa.bool_()), ("part", pa.int32()), ("edge", pa.int32())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        text, sha, ids, opening = None, "", [], 1
        ready: list[tuple] = []

        def close(last: bool) -> None:
            nonlocal opening
            edge = opening + 2 * last
            ready.extend((x, sha, ids[0], len(ids), j == 0, j == 0, part, edge) for j, x in enumerate(ids))
            opening = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*ready), schema)], schema=schema)
            ready.clear()
            return out

        for batch in batches:
            for key, t, s in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                if t != text or not ids:
                    if ids:
                        close(False)
                    text, sha, ids = t, s, []
                ids.append(key)
            if len(ready) > 20_000:
                yield flush()
        if ids:
            close(True)
        if ready:
            yield flush()

    return work


def exact_groups(docs: DataFrame, normalise: Callable[[Column], Column] = same, keep: str = "min",
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``;
    ``keep``: the smallest ("min") or the largest ("max") id of equal texts stays."""
    largest, spark = keep == "max", docs.sparkSession
    text = normalise(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", "text", F.sha2("text", 256).alias("sha"), F.substring("text", 1, LEAD).alias("lead"))
    by_id = F.col("doc_id").desc_nulls_last() if largest else F.col("doc_id").asc_nulls_last()
    dealt = rows.repartitionByRange(partitions_for(spark), "lead", "sha", by_id)
    runs = (dealt.sortWithinPartitions("lead", "sha", "text", by_id).select("doc_id", "text", "sha")
            .mapInArrow(_runs(), _RUNS))
    runs = stored(runs, "exact_runs")
    joined = _over_borders(runs)
    return (runs.join(F.broadcast(joined), ["part", "edge"], "left")
            .select("doc_id", F.when(F.col("whole_size").isNotNull(), F.col("whole_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("whole_size", "group_size").alias("group_size"),
                    (F.col("kept") & F.coalesce("opens", F.lit(True))).alias("kept"), "text_sha256"))


def _over_borders(runs: DataFrame) -> DataFrame:
    """The runs that reach over a border: (part, edge) -> id kept and size of the
    whole run, and whether the run opens there.  Two rows per partition at most
    pass through the driver."""
    edges = (runs.where("edge > 0 and first").select("part", "edge", "text_sha256", "keep_id", "group_size").collect())
    edges.sort(key=lambda r: (r.part, r.edge == 2))
    whole: list[list] = []
    for r in edges:
        met = whole and whole[-1][-1].text_sha256 == r.text_sha256 and r.edge != 2 and whole[-1][-1].edge != 1
        if met:
            whole[-1].append(r)
        else:
            whole.append([r])
    rows = [(r.part, r.edge, g[0].keep_id, sum(x.group_size for x in g), r is g[0]) for g in whole if len(g) > 1 for r in g]
    return runs.sparkSession.createDataFrame(rows, "part int, edge int, whole_keep long, whole_size long, opens boolean")


def op10_exact_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(load(spark, sf_dir, "documents"), keep="max")


OP10_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
