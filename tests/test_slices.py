"""Slices of a feed: numbering, and slices applied at once against a loop of merges."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge as M
from tidemark.operators import slices as SL
from tidemark.plans import fixtures as FX
from tidemark.plans.ingest import frame_input
from tidemark.sources.feeds import read_lines
from tests.conftest import SF_SMALL


def test_lines_of_files_in_many_splits(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "in")
    os.makedirs(folder)
    want = []
    for name, n in (("a.txt", 900), ("b.txt", 1), ("c.txt", 0), ("d.txt", 700)):
        lines = [f"{name} {i} " + "x" * (i * 7 % 50) if i % 5 else "" for i in range(n)]
        want += lines
        with open(os.path.join(folder, name), "w") as f:
            f.write("".join(x + "\n" for x in lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        read_lines(spark, folder).write.parquet(os.path.join(tmp_dir, "stored"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    stored = spark.read.parquet(os.path.join(tmp_dir, "stored"))
    assert stored.select("pos.file", "pos.block").distinct().count() > 10
    got = SL.line_numbers(stored).select("line", "value").orderBy("line").collect()
    assert [r.line for r in got] == list(range(1601)) and [r.value for r in got] == want
    cut = {r["slice"]: (r.first_line, r.last_line, r.rows) for r in SL.slice_summary(SL.line_numbers(stored), 500).collect()}
    assert cut == {0: (0, 499, 500), 1: (500, 999, 500), 2: (1000, 1499, 500), 3: (1500, 1600, 101)}


def test_no_task_numbers_all_rows(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("o"))
    out = SL.row_numbers(df, "o")
    assert out.agg(F.min("line"), F.max("line"), F.countDistinct("line")).first()[:] == (0, 9999, 10_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    rows = [r.o for r in out.orderBy("line").collect()]
    assert rows == sorted(rows)


@pytest.mark.parametrize("size", [1, 3, 7, 40, 1000])
def test_slices_equal_a_loop_of_merges(spark, size):
    rng = random.Random(size)
    rows = [(rng.choice([None, *range(12)]), rng.randrange(3), rng.choice("AAOODDX"), i) for i in range(60)]
    feed = spark.createDataFrame(rows, "k long, o_custkey long, flag string, seq long")
    spec = FX.ORDERS_SPEC
    state = spark.createDataFrame([(k, 1, "O", 1.0, "p", "A") for k in range(0, 12, 2)], spec.schema)
    mi, _ = frame_input(feed, spec, "seq")
    got = {r["slice"]: r for r in SL.slice_totals(SL.slice_changes(_sliced(mi, size), state)).collect()}
    for s in range(-(-60 // size)):
        part, _ = frame_input(feed.where((F.col("seq") >= s * size) & (F.col("seq") < (s + 1) * size)), spec, "seq")
        if size < 40 and s > 4:
            break                                              # a loop of merges is slow
        want = M.change_summary(M.merge(state, part, counted=True, how="right_outer")).first()
        assert [got[s][c] for c in ("received", "inserted", "updated", "deleted", "unchanged", "rejected")] == [
            want[c] for c in ("received", "inserted", "updated", "deleted", "unchanged", "rejected")], s
        state = spark.createDataFrame(M.next_state(M.merge(state, part), part).collect(), spec.schema)
    total = SL.feed_totals(SL.slice_totals(SL.slice_changes(_sliced(mi, size), state))).first()
    assert total.received == 60 and total.slices == -(-60 // size)


def _sliced(mi, size):
    from dataclasses import replace
    return replace(mi, feed=mi.feed.withColumn("slice", SL.slice_of("pos", size)))


def test_the_registered_feed_deletes_and_adds_keys_again(spark):
    from tidemark.plans.catalog import _f1_slices
    rows = _f1_slices(spark, SF_SMALL).orderBy("slice").collect()
    assert len(rows) >= 3 and sum(r.received for r in rows) == 896
    feed = FX.f1_feed(spark, SF_SMALL).where("k IS NOT NULL").groupBy("k").agg(F.collect_set("flag").alias("f"))
    assert feed.where(F.array_contains("f", "D") & F.array_contains("f", "O")).count() > 0
