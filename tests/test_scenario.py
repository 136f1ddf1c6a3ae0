"""The documented end-to-end scenario and the run-status outcomes."""

import os

from pyspark.sql import functions as F

from tidemark.plans import fixtures as FX
from tidemark.plans.ingest import apply_feed, frame_input, records_input
from tidemark.sources.feeds import read_feed
from tidemark.sources.store import SnapshotStore
from tests.conftest import SF_SMALL

COLS = ["k", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _rows(spark):
    o = FX.table(spark, SF_SMALL, "orders").where(F.col("o_orderkey") < 100)
    return o.select(F.col("o_orderkey").alias("k"), *COLS[1:], F.col("o_orderkey").alias("seq"))


def _apply(store, df):
    mi, _ = frame_input(df, FX.ORDERS_SPEC, order="seq")
    return apply_feed(mi, store)


def test_insert_update_delete_scenario(spark, tmp_dir):
    store = SnapshotStore(spark, os.path.join(tmp_dir, "orders"), FX.ORDERS_SPEC)
    base = _rows(spark)
    r1 = _apply(store, base.withColumn("flag", F.lit("A")))
    assert (r1.status, r1.inserted, r1.updated, r1.unchanged) == ("SUCCESS", 100, 0, 0)
    assert store.read().count() == 100

    changed = F.col("k") % 2 == 0
    phase2 = base.select(*COLS[:3], F.when(changed, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
                         .alias("o_totalprice"), "o_orderpriority",
                         F.when(changed, "O").otherwise("A").alias("flag"), "seq")
    r2 = _apply(store, phase2)
    assert (r2.updated, r2.unchanged, r2.inserted, r2.deleted) == (50, 50, 0, 0)
    assert r2.processed == 50 and r2.rejected == 0

    r3 = _apply(store, base.where(F.col("k") < 30).withColumn("flag", F.lit("D")))
    assert (r3.deleted, r3.rejected) == (30, 0)
    assert store.read().count() == 70
    assert store.current_version() == 3


def test_no_data_message_is_empty(spark, tmp_dir):
    p = os.path.join(tmp_dir, "feed.txt")
    with open(p, "w") as f:
        f.write('{"Message":"No Data Found"}\n')
    feed = read_feed(spark, p)
    assert feed.records.count() == 0
    mi, _ = records_input(feed.records, FX.ORDERS_SPEC, vocabulary=["k", "flag"])
    store = SnapshotStore(spark, os.path.join(tmp_dir, "s"), FX.ORDERS_SPEC)
    assert apply_feed(mi, store).status == "EMPTY"


def test_fractional_integer_fails_feed(spark, tmp_dir):
    df = spark.createDataFrame([("1", "12.5", "A", 1), ("2", "7", "A", 2)], "k string, o_custkey string, flag string, seq long")
    mi, _ = frame_input(df, FX.ORDERS_SPEC, order="seq")
    store = SnapshotStore(spark, os.path.join(tmp_dir, "s"), FX.ORDERS_SPEC)
    res = apply_feed(mi, store)
    assert res.status == "FAILED" and store.current_version() is None
    mi, _ = frame_input(df, FX.ORDERS_SPEC, order="seq", on_fraction="null")
    res = apply_feed(mi, store)
    assert res.status == "SUCCESS"
    assert {r["k"]: r["o_custkey"] for r in store.read().collect()} == {1: None, 2: 7}


def test_missing_pk_is_validation_failure(spark, tmp_dir):
    df = spark.createDataFrame([(5, "A", 1)], "o_custkey long, flag string, seq long")
    mi, plan = frame_input(df, FX.ORDERS_SPEC, order="seq")
    store = SnapshotStore(spark, os.path.join(tmp_dir, "s"), FX.ORDERS_SPEC)
    assert apply_feed(mi, store).status == "VALIDATION_FAILED"


def test_bulk_null_key_fails(spark, tmp_dir):
    mi, _ = frame_input(FX.f1_feed(spark, SF_SMALL), FX.ORDERS_SPEC, order="seq", require_flag=True)
    store = SnapshotStore(spark, os.path.join(tmp_dir, "s"), FX.ORDERS_SPEC)
    assert apply_feed(mi, store, mode="bulk").status == "FAILED"


def test_ingest_files_with_run_log(spark, tmp_dir):
    import datetime as dt
    from tidemark.plans.ingest import RunLog, ingest
    from tidemark.operators.runlog import missed_runs
    feed_dir = os.path.join(tmp_dir, "in")
    os.makedirs(feed_dir)
    with open(os.path.join(feed_dir, "part-0.txt"), "w") as f:
        f.write('{"Table":[{"K":"1","O_CUSTKEY":"10","FLAG":"a"},\n{"K":"2","O_CUSTKEY":"20","FLAG":"A"},\n')
        f.write('{"K":"","O_CUSTKEY":"30","FLAG":"A"},\n{"K":"1","O_CUSTKEY":"11","FLAG":"O"}]}\n')
    store = SnapshotStore(spark, os.path.join(tmp_dir, "state"), FX.ORDERS_SPEC)
    log = RunLog(spark, os.path.join(tmp_dir, "log"))
    r = ingest(spark, feed_dir, FX.ORDERS_SPEC, store, log, now=dt.datetime(2024, 3, 2, 5, 30))
    assert (r["status"], r["rows_received"], r["rows_inserted"], r["rows_rejected"]) == ("SUCCESS", 4, 2, 2)
    assert {x["k"]: x["o_custkey"] for x in store.read().collect()} == {1: 11, 2: 20}
    t = log.table().collect()
    assert len(t) == 1 and t[0]["status"] == "SUCCESS" and str(t[0]["requested_date"]) == "2024-03-01"
    assert ingest(spark, feed_dir, None, store, log, feed_name="nope")["status"] == "TABLE_NOT_FOUND"
    expected = spark.createDataFrame([("orders_cdc", dt.date(2024, 3, 1)), ("other", dt.date(2024, 3, 1))],
                                     "feed_name string, requested_date date")
    assert [x["feed_name"] for x in missed_runs(expected, log.table()).collect()] == ["other"]
