"""Snapshot store: versions, damaged pointers, dead writers, reopening in another process."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import merge as M
from tidemark.plans import fixtures as FX
from tidemark.plans.ingest import apply_feed, frame_input
from tidemark.session import scratch_path
from tidemark.sources.store import BrokenSnapshot, Conflict, SnapshotStore

def _scratch(spark):
    path = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    os.makedirs(path, exist_ok=True)
    return path


REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _feed(spark, lo, hi, bump, flag="O"):
    o = FX.table(spark, SF_SMALL, "orders").where((F.col("o_orderkey") >= lo) & (F.col("o_orderkey") < hi))
    return o.select(F.col("o_orderkey").alias("k"), "o_custkey", "o_orderstatus",
                    (F.col("o_totalprice") + bump).alias("o_totalprice"), "o_orderpriority",
                    F.lit(flag).alias("flag"), F.col("o_orderkey").alias("seq"))


def _apply(store, df, **kw):
    return apply_feed(frame_input(df, FX.ORDERS_SPEC, "seq")[0], store, **kw)


def _merges(spark, store, check):
    """Merges one after the other against whole merges of a collected state."""
    store.write(FX.f1_target(spark, SF_SMALL))
    state = FX.f1_target(spark, SF_SMALL)
    steps = [_feed(spark, 3, 6, 1.0), _feed(spark, 20, 23, 0.0, "A").withColumn("k", F.col("k") + 5000), _feed(spark, 10, 12, 0.0, "D"),
             _feed(spark, 3, 5, 2.0), _feed(spark, 10, 11, 5.0, "A"), _feed(spark, 0, 1500, 3.0)]
    for i, df in enumerate(steps):
        mi, _ = frame_input(df, FX.ORDERS_SPEC, "seq")
        state = spark.createDataFrame(M.next_state(M.merge(state, mi), mi).collect(), FX.ORDERS_SPEC.schema)
        r = _apply(store, df)
        assert (r.status, r.version) == ("SUCCESS", i + 2)
        check(sorted(store.read().collect()) == sorted(state.collect()))


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_small_and_large_feeds_give_the_same_rows(spark, tmp_dir, threshold):
    def check(same):
        assert same

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        _merges(spark, SnapshotStore(spark, os.path.join(tmp_dir, "s"), FX.ORDERS_SPEC), check)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nothing_changed_publishes_nothing(spark, tmp_dir):
    store = SnapshotStore(spark, os.path.join(tmp_dir, "s"), FX.ORDERS_SPEC)
    store.write(FX.f1_target(spark, SF_SMALL))
    r = _apply(store, _feed(spark, 3, 9, 0.0, "A"))
    assert (r.status, r.unchanged, r.version, store.current_version()) == ("SUCCESS", 6, 1, 1)
    assert len(os.listdir(os.path.join(tmp_dir, "s", "versions"))) == 1


def test_two_versions_stay(spark, tmp_dir):
    store = SnapshotStore(spark, os.path.join(tmp_dir, "s"), FX.ORDERS_SPEC)
    store.write(FX.f1_target(spark, SF_SMALL))
    before = store.read()
    for i in range(3):
        assert _apply(store, _feed(spark, 3, 4, 1.0 + i)).version == i + 2
        assert len(os.listdir(os.path.join(tmp_dir, "s", "versions"))) == 2
        assert before.count() == 1350                          # a reader of the version before goes on
        before = store.read()


def _published(spark, tmp_dir):
    root = os.path.join(tmp_dir, "s")
    store = SnapshotStore(spark, root, FX.ORDERS_SPEC)
    store.write(FX.f1_target(spark, SF_SMALL))
    return store, os.path.join(root, "current.json")


@pytest.mark.parametrize("damage", ["empty", "cut", "gone", "other"])
def test_a_damaged_pointer_is_an_error(spark, tmp_dir, damage):
    store, pointer = _published(spark, tmp_dir)
    text = open(pointer).read()
    os.remove(os.path.join(tmp_dir, "s", ".current.json.crc"))
    if damage == "gone":
        os.remove(pointer)
    else:
        with open(pointer, "w") as f:
            f.write({"empty": "", "cut": text[:len(text) // 2], "other": "[1]"}[damage])
    for act in (store.read, store.current_version, lambda: store.write(FX.f1_target(spark, SF_SMALL))):
        with pytest.raises(BrokenSnapshot):
            act()
    with pytest.raises(BrokenSnapshot):
        _apply(store, _feed(spark, 3, 4, 1.0))


def test_a_dead_writer_leaves_the_version(spark, tmp_dir):
    """Dead before anything was published, during a later write, and before the rename."""
    root = os.path.join(tmp_dir, "s")
    store = SnapshotStore(spark, root, FX.ORDERS_SPEC)
    store.stage(FX.f1_target(spark, SF_SMALL))
    again = SnapshotStore(spark, root, FX.ORDERS_SPEC)
    assert again.current_version() is None and again.read().count() == 0
    assert again.write(FX.f1_target(spark, SF_SMALL)) == 1
    again.stage(_feed(spark, 3, 4, 1.0).withColumn("flag", F.lit("A")))
    with open(os.path.join(root, "_half.json"), "w") as f:
        f.write('{"version": 9')
    assert (again.read().count(), again.current_version()) == (1350, 1)
    r = _apply(SnapshotStore(spark, root, FX.ORDERS_SPEC), _feed(spark, 3, 4, 1.0))
    assert (r.status, r.updated, r.inserted, again.read().count()) == ("SUCCESS", 1, 0, 1350)


def test_failed_feed_reads_no_target_and_leaves_the_version(spark, tmp_dir):
    store = SnapshotStore(spark, os.path.join(tmp_dir, "s"), FX.ORDERS_SPEC)
    store.write(FX.f1_target(spark, SF_SMALL))
    bad = spark.createDataFrame([("3", "1.5", "O", 1)], "k string, o_custkey string, flag string, seq long")
    store.read = None                                          # would raise if it were called
    r = _apply(store, bad)
    assert r.status == "FAILED" and store.current_version() == 1


def test_a_version_built_on_an_old_one_is_not_published(spark, tmp_dir):
    root = os.path.join(tmp_dir, "s")
    a, b = (SnapshotStore(spark, root, FX.ORDERS_SPEC) for _ in range(2))
    a.write(FX.f1_target(spark, SF_SMALL))
    real, raced = b.stage, []

    def stage(df):
        folder = real(df)
        raced.append(_apply(a, _feed(spark, 3, 4, 1.0)).version)
        return folder

    b.stage = stage
    r = _apply(b, _feed(spark, 5, 6, 1.0))
    assert raced == [2] and r.status == "FAILED" and "published during the write" in r.error and r.processed == 0
    assert a.current_version() == 2 and a.read().count() == a.read().select("k").distinct().count() == 1350
    with pytest.raises(Conflict):
        b.publish(real(FX.f1_target(spark, SF_SMALL)), 1)


_OTHER = """
import sys
sys.path.insert(0, {repo!r})
from tidemark.session import builder
from tidemark.plans import fixtures as FX
from tidemark.plans.ingest import apply_feed, frame_input
from tidemark.sources.store import SnapshotStore
from tests.test_store import _feed
spark = builder("local[2]", 4).config("spark.checkpoint.dir", {tmp!r}).config("spark.sql.warehouse.dir", {tmp!r} + "/w").getOrCreate()
store = SnapshotStore(spark, {root!r}, FX.ORDERS_SPEC)
before = store.read().count()
r = apply_feed(frame_input(_feed(spark, 3, 9, 1.0), FX.ORDERS_SPEC, "seq")[0], store)
print("OTHER", before, r.status, r.inserted, r.updated, store.read().count())
spark.stop()
"""


def test_another_application_reads_and_merges(spark, tmp_dir):
    root = os.path.join(tmp_dir, "s")
    store = SnapshotStore(spark, root, FX.ORDERS_SPEC)
    store.write(FX.f1_target(spark, SF_SMALL))
    code = _OTHER.format(repo=REPO, tmp=os.path.join(tmp_dir, "ck"), root=root)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=tmp_dir)
    line = [x for x in out.stdout.splitlines() if x.startswith("OTHER")]
    assert line == ["OTHER 1350 SUCCESS 0 6 1350"], out.stderr[-2000:]
    assert store.current_version() == 2 and store.read().count() == 1350


def test_scratch_is_given_back(spark, tmp_dir):
    store, _ = _published(spark, tmp_dir)
    before = set(os.listdir(_scratch(spark)))
    assert _apply(store, _feed(spark, 3, 9, 1.0)).updated == 6
    assert set(os.listdir(_scratch(spark))) == before
