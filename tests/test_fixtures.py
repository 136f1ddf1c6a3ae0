"""The numbers of FIXTURES.md, computed with the library (sf0.001 and sf0.01)."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalog as C
from tidemark.plans import fixtures as FX
from tidemark.operators import runlog as RL
from tidemark.operators import manifest as MF

SF = {"0.001": "/root/testdata/sf0.001", "0.01": "/root/testdata/sf0.01"}

F1 = {"0.001": dict(received=896, inserted=38, updated=266, deleted=26, unchanged=117, rejected=449,
                    null_pk=100, duplicates=296, unmatched_deletes=7, unknown_flags=46, state=1362, target=1350),
      "0.01": dict(received=8955, inserted=389, updated=2662, deleted=260, unchanged=1169, rejected=4475,
                   null_pk=1000, duplicates=2955, unmatched_deletes=65, unknown_flags=455, state=13629, target=13500)}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_f1_change_counts(spark, sf):
    row = C.QUERIES["agg_change_counts"](spark, SF[sf]).first().asDict()
    exp = dict(F1[sf])
    state, target = exp.pop("state"), exp.pop("target")
    assert row == exp
    assert row["rejected"] == row["null_pk"] + row["duplicates"] + row["unmatched_deletes"] + row["unknown_flags"]
    assert C.QUERIES["merge_apply"](spark, SF[sf]).count() == state == target + row["inserted"] - row["deleted"]


@pytest.mark.parametrize("sf,rows,integral,numeric,fractional",
                         [("0.001", 6000, 4342, 5047, 705), ("0.01", 60000, 43093, 50449, 7356)])
def test_f3_coercion_counts(spark, sf, rows, integral, numeric, fractional):
    r = C.QUERIES["agg_coerce_counts"](spark, SF[sf]).first()
    assert (r["rows_total"], r["integral"], r["numeric"], r["fractional"]) == (rows, integral, numeric, fractional)


def test_f3_lineitem_keys_not_unique(spark):
    assert C.QUERIES["lineitem_keep_last"](spark, SF["0.001"]).count() == 4599


@pytest.mark.parametrize("sf,runs,dates,pairs,missed,succeeded,open_,expired",
                         [("0.001", 1000, 31, 212, 18, 390, 199, 520), ("0.01", 10000, 31, 217, 0, 3963, 2017, 4985)])
def test_f4_run_log(spark, sf, runs, dates, pairs, missed, succeeded, open_, expired):
    r = FX.run_events(spark, SF[sf])
    assert r.count() == runs
    assert r.select("requested_date").distinct().count() == dates
    assert r.select("feed_name", "requested_date").distinct().count() == pairs
    seen = r.select("feed_name", "requested_date").distinct()
    assert RL.missed_runs(seen, r).count() == missed
    # the query expects all 7 feeds on all days, and a feed that never ran
    assert C.QUERIES["join_missed_runs"](spark, SF[sf]).count() == missed + (7 * dates - pairs) + dates
    assert RL.run_summary(r, []).first()["succeeded"] == succeeded
    assert C.QUERIES["close_stale"](spark, SF[sf]).count() == open_
    assert C.QUERIES["expire_rows"](spark, SF[sf]).count() == expired


@pytest.mark.parametrize("sf,names,matching,loaded,new", [("0.001", 200, 181, 60, 121), ("0.01", 1000, 909, 303, 606)])
def test_f5_manifest(spark, sf, names, matching, loaded, new):
    listing = FX.report_listing(spark, SF[sf])
    assert listing.count() == names
    c = MF.manifest_counts(MF.catalog(listing, FX.report_manifest(spark, SF[sf]))).first()
    assert (c["received"], c["unchanged"], c["inserted"], c["rejected"], c["status"]) == (matching, loaded, new, 0, "SUCCESS")
    # the query lets the transfer of some new files fail
    c = C.QUERIES["agg_manifest_counts"](spark, SF[sf]).first()
    assert (c["received"], c["unchanged"], c["inserted"] + c["rejected"], c["status"]) == (matching, loaded, new, "WARNINGS")
    assert MF.loaded_names(FX.report_manifest(spark, SF[sf])).count() == loaded


def test_f6_stream_final_state(spark):
    df = C.QUERIES["stream_merge"](spark, SF["0.001"])
    r = df.agg(F.count("*").alias("n"), F.sum("event_id").alias("s")).first()
    assert (r["n"], r["s"]) == (15, 14791)


def test_f6_state_independent_of_file_count(spark):
    a = C._events_by_stream(spark, SF["0.001"], parts=2, files_per_trigger=1)
    b = C._events_by_stream(spark, SF["0.001"], parts=1, files_per_trigger=3)
    assert sorted(a.current().collect()) == sorted(b.current().collect())
