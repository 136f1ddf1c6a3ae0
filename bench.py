"""Benchmark: headline change-feed workloads on the benchmark tables.

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

Workloads (each over whole tables):
  dedup_lineitem      keep-last per (l_orderkey, l_linenumber) of lineitem
  ingest_json         lineitem as JSON-lines files -> parsed once and stored -> names -> conform -> keep-last
  merge_1pct / 10pct / 100pct
                      change feed on the deduplicated lineitem (1 %, 10 %, 100 % of keys
                      updated, plus deletes and new keys) applied to a stored snapshot
                      -> the next version written; counts observed during the writes
  merge_5keys         five keys updated
  orders_change_counts
                      the flagship F1 pipeline (reject, keep-last, classify, counts)

"written" gives the rows changed and the megabytes of each version of the snapshot.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F, types as T  # noqa: E402

from tidemark.operators.dedup import keep_last  # noqa: E402
from tidemark.plans import fixtures as FX  # noqa: E402
from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.plans.ingest import apply_feed, frame_input, records_input, staged  # noqa: E402
from tidemark.session import builder, scratch_path  # noqa: E402
from tidemark.sources.feeds import read_feed  # noqa: E402
from tidemark.sources.store import SnapshotStore  # noqa: E402
from tidemark.spec import TableSpec  # noqa: E402

LI_SPEC = TableSpec.of("lineitem_state", T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_partkey", T.LongType()), T.StructField("l_suppkey", T.LongType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()), T.StructField("flag", T.StringType()),
]), pk=["l_orderkey", "l_linenumber"])


def run(fn):
    t = time.time()
    fn()
    return round(time.time() - t, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = builder(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    li = FX.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    times = {}

    def dedup():
        w = keep_last(li.withColumn("pos", F.struct(*FX.LINEITEM_ORDER)), keys, "pos")
        w.write.format("noop").mode("overwrite").save()
    times["dedup_lineitem"] = run(dedup)

    # Setup (untimed): the feed as JSON-lines text files, as a vendor delivers it.
    feed_dir = scratch_path(spark, "bench-feed")
    (li.repartition(int(cpus) * 2).select(F.to_json(F.struct(*li.columns)).alias("value"))
       .write.text(feed_dir))

    def ingest_json():
        from tidemark.operators.merge import winners
        records, _ = staged(read_feed(spark, feed_dir, form="lines"), spark)
        mi, _ = records_input(records, LI_SPEC)
        winners(mi).write.format("noop").mode("overwrite").save()
    times["ingest_json"] = run(ingest_json)

    # Snapshot: deduplicated lineitem, unique keys.
    base = keep_last(li.withColumn("pos", F.struct(*FX.LINEITEM_ORDER)), keys, "pos").drop("pos") \
        .withColumn("flag", F.lit("A"))
    store = SnapshotStore(spark, scratch_path(spark, "bench-lineitem"), LI_SPEC)
    sizes = {}

    def written(name, rows):
        size = sum(os.path.getsize(f.removeprefix("file://")) for f in store.read().inputFiles())
        sizes[name] = {"rows_changed": rows, "mb_written": round(size / 1e6, 3)}

    def merge(name, feed):
        path, out = scratch_path(spark, "bench-merge"), []
        feed.write.parquet(path)
        feed = spark.read.schema(feed.schema).parquet(path)

        def work():
            out.append(apply_feed(frame_input(feed, LI_SPEC, order="seq")[0], store))
        times[name] = run(work)
        assert out[0].status == "SUCCESS", out[0].error
        written(name, out[0].processed)
        return out[0]

    times["snapshot_write"] = run(lambda: store.write(base))
    written("snapshot_write", None)
    for pct in (1, 10, 100):
        cur = store.read()
        h = F.abs(F.xxhash64("l_orderkey", "l_linenumber", F.lit(pct))) % 1000
        changed = cur.where(h < pct * 10)
        upd = changed.select(*[F.col(c) for c in keys],
                             (F.col("l_quantity") + 1).alias("l_quantity"), "l_extendedprice",
                             F.when(h % 20 == 0, "D").otherwise("O").alias("flag"))
        new = changed.where(h % 50 == 1).select((F.col("l_orderkey") + F.lit(10 ** 12)).alias("l_orderkey"),
                                                "l_linenumber", "l_quantity", "l_extendedprice",
                                                F.lit("A").alias("flag"))
        # Setup (untimed): the feed, stored
        feed = upd.unionByName(new).withColumn("seq", F.monotonically_increasing_id())
        merge(f"merge_{pct}pct", feed)
    cur = store.read().orderBy("l_orderkey", "l_linenumber").limit(5)
    tiny = cur.select(*[F.col(c) for c in keys], (F.col("l_quantity") + 7).alias("l_quantity"),
                      F.lit("O").alias("flag"), F.monotonically_increasing_id().alias("seq"))
    assert merge("merge_5keys", tiny).updated == 5

    times["orders_change_counts"] = run(
        lambda: QUERIES["agg_change_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save())
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "written": sizes, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
