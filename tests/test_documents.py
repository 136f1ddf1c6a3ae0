"""The change feeds as documents: whole, in order, and made by many tasks."""

import json
import os

from pyspark.sql import functions as F

from tidemark.plans import fixtures as FX
from tests.conftest import SF_SMALL


def test_a_document_is_sorted_by_many_tasks(spark, tmp_dir):
    """Its parts are put together in order, with one comma between any two records."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = FX.write_large_document(spark, SF_SMALL, os.path.join(tmp_dir, "one"))
        many = FX.write_feed_folder(spark, SF_SMALL, os.path.join(tmp_dir, "many"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = os.listdir(os.path.join(tmp_dir, "one-parts", "file=orders.json"))
    assert sum(p.startswith("part-") for p in parts) > 2
    with open(os.path.join(folder, "orders.json")) as f:
        got = json.load(f)["Table"]
    cols = ["k", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "flag"]
    want = [json.loads(r[0]) for r in FX.f1_feed(spark, SF_SMALL).orderBy("seq").select(F.to_json(F.struct(*cols))).collect()]
    assert got == want
    with open(os.path.join(many, FX.spelled("customer_feed", 0))) as f:
        assert [r[" C_CustKey "] for r in json.load(f)["Table"]] == [r[0] for r in FX.table(spark, SF_SMALL, "customer").select("c_custkey").orderBy("c_custkey").collect()]
    names = {f for f in os.listdir(many) if f.endswith(".txt") and not f.startswith(".")}
    assert {f"{t}_feed.txt".lower() for t in ("customer", "supplier", "part", "nation")} <= {n.lower() for n in names} and "unknown.txt" in names


def test_repeated_rows_and_rows_without_a_place_stay(spark, tmp_dir):
    rows = spark.createDataFrame([("a", None, '{"k":0}'), ("a", None, '{"k":0}'), ("a", 1, '{"k":1}'), ("b", 2, '{"k":2}'), ("b", 2, '{"k":2}')], "file string, o long, value string")
    FX._as_documents(rows, os.path.join(tmp_dir, "d"), "o")
    read = lambda n: [r["k"] for r in json.load(open(os.path.join(tmp_dir, "d", n)))["Table"]]
    assert (read("a"), read("b")) == ([0, 0, 1], [2, 2])
