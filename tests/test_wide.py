"""A 370-column table (the widest the model has): conform, keep-last and merge
stay single-select / single-struct plans and give exact counts."""

import os

from pyspark.sql import functions as F, types as T

from tidemark.plans import fixtures as FX
from tidemark.plans.ingest import apply_feed, frame_input
from tidemark.sources.store import SnapshotStore
from tidemark.spec import TableSpec
from tests.conftest import SF_SMALL

N_MEASURES = 368          # + 2 key columns = 370


def _spec():
    fields = [T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType())]
    fields += [T.StructField(f"m{i:03d}", T.DoubleType()) for i in range(N_MEASURES)]
    return TableSpec.of("wide", T.StructType(fields + [T.StructField("flag", T.StringType())]),
                        pk=["l_orderkey", "l_linenumber"])


def _rows(spark, bump):
    li = FX.table(spark, SF_SMALL, "lineitem")
    first = li.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_extendedprice").alias("p"))
    # measure i = p * (i + 1) rendered as text, as a vendor feed would send it
    cols = [(F.col("p") * (i + 1) + bump).cast("string").alias(f"M{i:03d}") for i in range(N_MEASURES)]
    return first.select("l_orderkey", "l_linenumber", *cols)


def test_wide_merge(spark, tmp_dir):
    spec = _spec()
    store = SnapshotStore(spark, os.path.join(tmp_dir, "wide"), spec)
    base = _rows(spark, 0).withColumn("flag", F.lit("A")).withColumn("seq", F.monotonically_increasing_id())
    mi, plan = frame_input(base, spec, order="seq")
    assert len(plan.present) == N_MEASURES + 3          # keys, measures, flag
    r1 = apply_feed(mi, store)
    n = FX.table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber").distinct().count()
    assert (r1.status, r1.inserted) == ("SUCCESS", n)
    upd = (_rows(spark, 1).where(F.col("l_orderkey") % 2 == 0)
           .withColumn("flag", F.lit("O")).withColumn("seq", F.monotonically_increasing_id()))
    mi, _ = frame_input(upd, spec, order="seq")
    r2 = apply_feed(mi, store)
    expect = upd.count()
    assert (r2.updated, r2.inserted, r2.unchanged) == (expect, 0, 0)
    assert store.read().count() == n
