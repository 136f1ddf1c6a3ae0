"""Merge semantics: the traps of the survey and invariants."""

import os

from pyspark.sql import functions as F

from tidemark.operators import merge as M
from tidemark.operators.dedup import keep_last, keep_last_window
from tidemark.plans import fixtures as FX
from tidemark.plans.ingest import apply_feed, frame_input
from tidemark.sources.store import SnapshotStore
from tests.conftest import SF_SMALL

SCHEMA = "k long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string, flag string, seq long"


def _mi(spark, rows, schema=SCHEMA, **kw):
    mi, _ = frame_input(spark.createDataFrame(rows, schema), FX.ORDERS_SPEC, order="seq", **kw)
    return mi


def _target(spark, rows):
    return spark.createDataFrame(rows, "k long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                       "o_orderpriority string, flag string")


def _actions(spark, target, mi, **kw):
    c = M.merge(target, mi, **kw)
    return {r["k"]: r["action"] for r in M.changes(c, mi).collect()}


def test_unknown_flag_last_hides_good_row(spark):
    t = _target(spark, [(1, 1, "O", 1.0, "p", "A")])
    mi = _mi(spark, [(1, 2, "O", 1.0, "p", "O", 1), (1, 2, "O", 1.0, "p", "X", 2)])
    assert _actions(spark, t, mi) == {1: "ignored"}
    assert _actions(spark, t, mi, ignore_unknown_flags_first=True) == {1: "update"}


def test_flag_is_compared(spark):
    t = _target(spark, [(1, 1, "O", 1.0, "p", "A")])
    mi = _mi(spark, [(1, 1, "O", 1.0, "p", "O", 1)])
    assert _actions(spark, t, mi) == {1: "update"}
    mi, _ = frame_input(spark.createDataFrame([(1, 1, "O", 1.0, "p", "O", 1)], SCHEMA), FX.ORDERS_NOFLAG_SPEC, "seq")
    t2 = t.drop("flag")
    assert _actions(spark, t2, mi) == {1: "unchanged"}


def test_present_null_overwrites_absent_keeps(spark):
    t = _target(spark, [(1, 1, "O", 1.0, "p", "A"), (2, 2, "F", 2.0, "q", "A")])
    mi = _mi(spark, [(1, 9, None, 1.0, "p", "O", 1)])
    s = {r["k"]: r for r in M.next_state(M.merge(t, mi), mi).collect()}
    assert s[1]["o_orderstatus"] is None and s[1]["o_custkey"] == 9
    feed = spark.createDataFrame([(1, 9, "O", 1)], "k long, o_custkey long, flag string, seq long")
    mi, _ = frame_input(feed, FX.ORDERS_SPEC, "seq")
    s = {r["k"]: r for r in M.next_state(M.merge(t, mi), mi).collect()}
    assert s[1]["o_orderstatus"] == "O" and s[1]["o_priority" if False else "o_orderpriority"] == "p"


def test_key_only_feed_does_nothing_on_match(spark):
    t = _target(spark, [(1, 1, "O", 1.0, "p", "A")])
    feed = spark.createDataFrame([(1, 1), (3, 2)], "k long, seq long")
    mi, _ = frame_input(feed, FX.ORDERS_NOFLAG_SPEC, "seq")
    assert _actions(spark, t.drop("flag"), mi) == {1: "unchanged", 3: "insert"}


def test_blank_text_key_is_rejected_and_text_is_trimmed(spark):
    spec_schema = "k string, flag string, seq long"
    from tidemark.spec import TableSpec
    from pyspark.sql import types as T
    spec = TableSpec.of("t", T.StructType([T.StructField("k", T.StringType()), T.StructField("flag", T.StringType())]),
                        pk=["k"])
    feed = spark.createDataFrame([(" S", "A", 1), ("S ", "A", 2), ("  ", "A", 3), ("none", "A", 4)], spec_schema)
    mi, _ = frame_input(feed, spec, "seq")
    w = M.winners(mi).collect()
    assert [(r["k"], r["pos"]) for r in w] == [("S", 2)]


def test_keep_last_matches_window_and_is_order_free(spark):
    li = FX.table(spark, SF_SMALL, "lineitem").withColumn("pos", F.struct(*FX.LINEITEM_ORDER))
    keys = ["l_orderkey", "l_linenumber"]
    a = keep_last(li, keys, "pos").collect()
    b = keep_last_window(li, keys, "pos").collect()
    c = keep_last(li.repartition(7).orderBy(F.rand(3)), keys, "pos").collect()
    assert sorted(a) == sorted(b) == sorted(c)


def test_merge_twice_is_all_unchanged(spark, tmp_dir):
    store = SnapshotStore(spark, os.path.join(tmp_dir, "s"), FX.ORDERS_SPEC)
    store.write(FX.f1_target(spark, SF_SMALL))
    mi, _ = frame_input(FX.f1_feed(spark, SF_SMALL), FX.ORDERS_SPEC, "seq")
    first = apply_feed(mi, store)
    second = apply_feed(mi, store)
    assert second.inserted == 0 and second.updated == 0 and second.deleted == 0
    assert second.unchanged == first.inserted + first.updated + first.unchanged


def test_ordered_micro_batches_equal_one_batch(spark, tmp_dir):
    one = SnapshotStore(spark, os.path.join(tmp_dir, "one"), FX.ORDERS_SPEC)
    many = SnapshotStore(spark, os.path.join(tmp_dir, "many"), FX.ORDERS_SPEC)
    for s in (one, many):
        s.write(FX.f1_target(spark, SF_SMALL))
    feed = FX.f1_feed(spark, SF_SMALL)
    mi, _ = frame_input(feed, FX.ORDERS_SPEC, "seq")
    apply_feed(mi, one)
    for part in range(3):                       # ordered slices by arrival position
        lo, hi = part * 5000, (part + 1) * 5000
        chunk = feed.where((F.col("seq") >= lo) & (F.col("seq") < hi))
        mi, _ = frame_input(chunk, FX.ORDERS_SPEC, "seq")
        apply_feed(mi, many)
    assert sorted(one.read().collect()) == sorted(many.read().collect())
