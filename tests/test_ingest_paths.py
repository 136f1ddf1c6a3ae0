"""ingest() over document feeds and bulk mode; the version guard."""

import datetime as dt
import os


from tidemark.operators import merge as M
from tidemark.plans import fixtures as FX
from tidemark.plans.ingest import RunLog, frame_input, ingest
from tidemark.sources.store import SnapshotStore


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_document_feed_and_bulk_mode(spark, tmp_dir):
    store = SnapshotStore(spark, os.path.join(tmp_dir, "s"), FX.ORDERS_SPEC)
    log = RunLog(spark, os.path.join(tmp_dir, "log"))
    doc = os.path.join(tmp_dir, "doc.json")
    _write(doc, '{\n "Table": [\n  {"k": 1, "o_custkey": 5, "flag": "A"},\n  {"k": 2, "o_custkey": 6, "flag": "A"}\n ]\n}\n')
    r = ingest(spark, doc, FX.ORDERS_SPEC, store, log, now=dt.datetime(2024, 5, 1, 12))
    assert (r["status"], r["rows_inserted"]) == ("SUCCESS", 2)
    # bulk: D and A for one key -> deleted then inserted (absent columns NULL); counts are candidates
    bulk = os.path.join(tmp_dir, "bulk.txt")
    _write(bulk, '{"k": 1, "flag": "D"}\n{"k": 1, "o_orderstatus": "F", "flag": "A"}\n{"k": 2, "flag": "D"}\n')
    r = ingest(spark, bulk, FX.ORDERS_SPEC, store, log, mode="bulk", now=dt.datetime(2024, 5, 1, 13))
    assert r["status"] == "SUCCESS"
    rows = {x["k"]: x for x in store.read().collect()}
    assert set(rows) == {1} and rows[1]["o_custkey"] is None and rows[1]["o_orderstatus"] == "F"
    # bulk without a flag column fails
    noflag = os.path.join(tmp_dir, "noflag.txt")
    _write(noflag, '{"k": 3}\n')
    assert ingest(spark, noflag, FX.ORDERS_SPEC, store, log, mode="bulk")["status"] == "FAILED"
    statuses = sorted(x["status"] for x in log.table().collect())
    assert statuses == ["FAILED", "SUCCESS", "SUCCESS"]


def test_version_guard(spark):
    t = spark.createDataFrame([(1, 1, "O", 1.0, "p", "A"), (2, 1, "O", 1.0, "p", "A")],
                              "k long, o_custkey long, o_orderstatus string, o_totalprice double, "
                              "o_orderpriority string, flag string")
    feed = spark.createDataFrame([(1, 0, "O", 1), (2, 5, "O", 2)], "k long, o_custkey long, flag string, seq long")
    mi, _ = frame_input(feed, FX.ORDERS_SPEC, "seq")
    c = M.merge(t, mi, newer_than="o_custkey")
    acts = {r["k"]: r["action"] for r in M.changes(c, mi).collect()}
    assert acts == {1: "stale", 2: "update"}
    state = {r["k"]: r["o_custkey"] for r in M.next_state(c, mi).collect()}
    assert state == {1: 1, 2: 5}


def test_bulk_load_from_folder(spark, tmp_dir):
    from tidemark.plans import bulk as B
    d = os.path.join(tmp_dir, "feeds")
    os.makedirs(d)
    _write(os.path.join(d, "ORDERS_CDC.txt"),
           '{"Table": [{"K": 1, "o_custkey": 7, "Flag": "a"}, {"K": 2, "o_custkey": 8, "Flag": "A"},'
           ' {"K": 2, "Flag": "D"}, {"K": 3, "o_custkey": 9, "Flag": "A", "junk": 1}]}')
    _write(os.path.join(d, "customer_feed.txt"), '{"Table": [{"c_custkey": 1}')        # broken
    _write(os.path.join(d, "notes.txt"), "hello")
    _write(os.path.join(d, "orders_cdc.json"), "{}")                                    # not a .txt
    store = SnapshotStore(spark, os.path.join(tmp_dir, "s"), FX.ORDERS_SPEC)
    report = B.load_folder(spark, d, {"orders_cdc": FX.ORDERS_SPEC, "customer_feed": FX.CUSTOMER_SPEC}, {"orders_cdc": store})
    rep = {r["file"]: r for r in report.collect()}
    assert set(rep) == {"ORDERS_CDC.txt", "customer_feed.txt", "notes.txt"}
    o = rep["ORDERS_CDC.txt"]
    assert (o["structure"], o["load"], o["rows_loaded"]) == ("MISMATCH", "PASS", 4)
    assert "extra_json=['junk']" in o["notes"]
    assert rep["customer_feed.txt"]["structure"] == "PARSE ERROR"
    assert rep["notes.txt"]["table_name"] == "NOT FOUND"
    # bulk semantics in the snapshot: key 2 deleted first, then its A row inserted
    assert {r["k"]: r["o_custkey"] for r in store.read().collect()} == {1: 7, 2: 8, 3: 9}
