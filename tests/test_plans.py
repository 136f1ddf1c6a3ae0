"""Physical-plan properties the scale design relies on."""

import os

import pytest

from pyspark.sql import functions as F

from tidemark.operators import merge as M
from tidemark.operators.dedup import keep_last
from tidemark.plans import fixtures as FX
from tidemark.plans.ingest import apply_feed, frame_input
from tidemark.sources.store import SnapshotStore
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_last_combines_before_the_shuffle(spark):
    """A hot key is reduced map-side: a partial aggregate sits below the exchange."""
    li = FX.table(spark, SF_SMALL, "lineitem").withColumn("pos", F.struct(*FX.LINEITEM_ORDER))
    plan = _plan(keep_last(li, ["l_orderkey", "l_linenumber"], "pos"))
    lines = plan.split("\n")
    ex = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    assert any("partial_max_by" in l for l in lines[ex + 1:]), plan


def test_hot_key_is_whole(spark):
    """One key holding a third of the rows: still one exact winner, nothing dropped."""
    li = FX.table(spark, SF_SMALL, "lineitem")
    hot = li.select(F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("l_orderkey")).alias("k"),
                    F.monotonically_increasing_id().alias("pos"), "l_partkey")
    w = keep_last(hot.repartition(8), ["k"], "pos")
    top = w.where("k = -1").first()
    assert top["pos"] == hot.where("k = -1").agg(F.max("pos")).first()[0]
    assert w.count() == hot.select("k").distinct().count()


@pytest.mark.parametrize("small", [True, False])
def test_a_small_feed_does_not_shuffle_the_target(spark, tmp_dir, monkeypatch, small):
    """Semi and anti join against the broadcast winners; a large feed takes one full outer join."""
    store = SnapshotStore(spark, os.path.join(tmp_dir, "s"), FX.ORDERS_SPEC)
    store.write(FX.f1_target(spark, SF_SMALL))
    plans = []
    real = store.stage

    def stage(df):
        plans.append(_plan(df))
        return real(df)

    monkeypatch.setattr(store, "stage", stage)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    if not small:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        res = apply_feed(frame_input(FX.f1_feed(spark, SF_SMALL), FX.ORDERS_SPEC, "seq")[0], store)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert res.status == "SUCCESS" and len(plans) == 1
    if small:
        assert "BroadcastHashJoin" in plans[0] and "LeftAnti" in plans[0] and "Exchange hashpartitioning" not in plans[0], plans[0]
    else:
        assert plans[0].count("Exchange hashpartitioning") == 2 and "FullOuter" in plans[0], plans[0]


def test_deletes_are_a_semi_join(spark):
    mi, _ = frame_input(FX.f1_feed(spark, SF_SMALL), FX.ORDERS_SPEC, "seq")
    plan = _plan(M.deleted_keys(FX.f1_target(spark, SF_SMALL), M.winners(mi), ["k"]))
    assert "LeftSemi" in plan and "FullOuter" not in plan, plan


def test_change_counts_read_the_feed_once(spark):
    mi, _ = frame_input(FX.f1_feed(spark, SF_SMALL), FX.ORDERS_SPEC, "seq")
    plan = _plan(M.change_summary(M.merge(FX.f1_target(spark, SF_SMALL), mi, counted=True, how="right_outer")))
    assert plan.count("FileScan") == 5, plan       # the feed's four parts and the target


def test_feed_filters_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        mi, _ = frame_input(FX.f1_feed(spark, SF_SMALL), FX.ORDERS_SPEC, "seq")
        plan = _plan(M.winners(mi))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [IsNotNull(o_orderkey)" in plan, plan
    # column pruning: o_orderdate is never read
    schemas = [l for l in plan.split("\n") if "ReadSchema" in l]
    assert schemas and not any("o_orderdate" in l for l in schemas), plan


def test_no_python_udfs_in_plans(spark):
    mi, _ = frame_input(FX.f1_feed(spark, SF_SMALL), FX.ORDERS_SPEC, "seq")
    plan = _plan(M.change_summary(M.merge(FX.f1_target(spark, SF_SMALL), mi, counted=True)))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
