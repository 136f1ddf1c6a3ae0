"""One feed, one run: outcomes, counts and the run log."""

import datetime as dt
import os

import pytest
from pyspark.sql import types as T

from tidemark.operators.normalize import observed_columns, resolve_columns
from tidemark.plans import fixtures as FX
from tidemark.plans.ingest import RunLog, ingest, records_input, requested_date, staged
from tidemark.sources.feeds import read_feed
from tidemark.sources.store import SnapshotStore
from tidemark.spec import TableSpec

NOON = dt.datetime(2024, 5, 1, 12)
SPEC = TableSpec.of("Companyaddress", T.StructType([T.StructField("fincode", T.IntegerType()), T.StructField("name", T.StringType()),
                                                    T.StructField("amount", T.DoubleType()), T.StructField("flag", T.StringType())]), pk=["fincode", "name"])


def _file(tmp_dir, *lines, name="f.txt"):
    path = os.path.join(tmp_dir, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


@pytest.fixture
def place(spark, tmp_dir):
    return SnapshotStore(spark, os.path.join(tmp_dir, "s"), SPEC), RunLog(spark, os.path.join(tmp_dir, "log"))


def test_findings_malformed_lines_and_rejected_keys(spark, tmp_dir, place):
    store, log = place
    path = _file(tmp_dir, '{"fincode": 1, "name": "a"}', '{"fincode": 7, "name": null}', '{"fincode": 8, "name": " "}', '{"bad": ', '{"fincode": 7}')
    r = ingest(spark, path, SPEC, store, log, now=NOON)
    assert (r["status"], r["rows_received"], r["rows_inserted"], r["rows_malformed"], r["rows_rejected"]) == ("SUCCESS", 4, 1, 1, 3)
    assert len(r["warnings"]) == 1 and "'flag' is missing" in r["warnings"][0]
    run = log.table().first()
    assert (run.rows_malformed, run.rows_rejected) == (1, 3) and "flag" in run.warnings
    assert sorted((x.id, x.key) for x in log.rejected_keys().collect()) == [(run.id, "7"), (run.id, "8")]


def test_transport_outcomes(spark, tmp_dir, place):
    store, log = place
    for code, status in ((204, "NO_CONTENT"), (403, "API_ERROR"), (404, "API_ERROR")):
        assert ingest(spark, "/nowhere", SPEC, store, log, now=NOON, http_status=code)["status"] == status
    assert ingest(spark, "/nowhere", None, store, log, now=NOON, feed_name="x")["status"] == "TABLE_NOT_FOUND"
    assert ingest(spark, _file(tmp_dir, '{"Message":"No Data Found"}'), SPEC, store, log, now=NOON)["status"] == "EMPTY"
    assert ingest(spark, _file(tmp_dir, '{"name": "a"}'), SPEC, store, log, now=NOON)["status"] == "VALIDATION_FAILED"
    failed = ingest(spark, "/nowhere", SPEC, store, log, now=NOON)
    assert failed["status"] == "FAILED" and failed["error_message"]
    rows = log.table().collect()            # all started at the same moment
    assert len(rows) == len({r.id for r in rows}) == 7 and all(r.finished_at >= r.started_at for r in rows)


def test_late_finish_wins_over_abandoned_and_old_runs_expire(spark, tmp_dir, place):
    _, log = place
    day = dt.timedelta(days=1)
    for i, start in enumerate((NOON - 40 * day, NOON - 30 * day - dt.timedelta(hours=1), NOON - 29 * day, NOON)):
        log.append({"id": i, "feed_name": "f", "status": "STARTED", "started_at": start, "seq": 0, "requested_date": start.date()})
    log.abandon(NOON + dt.timedelta(hours=1))
    log.append({"id": 3, "feed_name": "f", "status": "SUCCESS", "started_at": NOON, "seq": 1, "finished_at": NOON + dt.timedelta(hours=2)})
    assert {r.id: r.status for r in log.table().collect()} == {0: "ABANDONED", 1: "ABANDONED", 2: "ABANDONED", 3: "SUCCESS"}
    log.expire(NOON, 30)
    assert {r.id for r in log.table().collect()} == {2, 3}
    log.expire(NOON, 30)
    assert {r.id for r in log.table().collect()} == {2, 3}
    days = sorted(x for x in os.listdir(os.path.join(tmp_dir, "log", "events")) if x.startswith("started_on"))
    assert days == ["started_on=2024-04-01", "started_on=2024-04-02", "started_on=2024-05-01"]


def test_business_date_in_the_feeds_zone():
    utc = dt.timezone.utc
    assert requested_date(dt.datetime(2024, 5, 1, 0, 20, tzinfo=utc)) == dt.date(2024, 4, 30)      # 05:50 in Kolkata
    assert requested_date(dt.datetime(2024, 5, 1, 0, 40, tzinfo=utc)) == dt.date(2024, 5, 1)       # 06:10
    assert requested_date(dt.datetime(2024, 5, 1, 5, 59)) == dt.date(2024, 4, 30)
    assert requested_date(dt.datetime(2024, 5, 1, 5, 59), "31012024") == dt.date(2024, 1, 31)


def test_parser_and_name_rules(spark, tmp_dir):
    path = _file(tmp_dir, '{"fincode": 1, "name": "a", "name": "b", "amount": NaN}', '{"\u00a0FinCode\\t": 2, "name": NaN, "amount": 2}')
    feed = read_feed(spark, path, form="lines")
    mi, plan = records_input(feed.records, SPEC)
    # two spellings of one name: the first is the column, as in a table with both columns
    assert plan.raw_for("fincode") == "fincode"
    assert [(r.fincode, r.name, r.amount) for r in mi.feed.orderBy("pos").collect()] == [(1, "b", None), (None, None, 2.0)]
    names = {r.raw_name: r.column_name for r in observed_columns(feed.records, SPEC).collect()}
    assert names["\u00a0FinCode\t"] == "fincode"


def test_last_spelling_of_a_vendor_name_is_renamed(spark):
    raw = ["c_custkey", "Account Balance", "ACCOUNT BALANCE", "x"]
    plan = resolve_columns(raw, FX.CUSTOMER_SPEC)
    assert plan.raw_for("c_acctbal") == "ACCOUNT BALANCE" and "account balance" in plan.extra
    rec = spark.createDataFrame([({k: "1" for k in raw}, 1)], "rec map<string,string>, pos long")
    got = {r.raw_name: r.column_name for r in observed_columns(rec, FX.CUSTOMER_SPEC).collect()}
    assert got == {"c_custkey": "c_custkey", "Account Balance": "account balance", "ACCOUNT BALANCE": "c_acctbal", "x": "x"}


def test_any_number_of_unknown_keys(spark, tmp_dir, place):
    store, log = place
    n = 120_000
    df = spark.range(n).selectExpr("concat('{\"fincode\": ', id, ', \"name\": \"a\", \"u', id, '\": 1, \"Flag\": \"A\"}') AS value")
    df.write.text(os.path.join(tmp_dir, "wide"))
    r = ingest(spark, os.path.join(tmp_dir, "wide"), SPEC, store, log, now=NOON, form="lines")
    assert (r["status"], r["rows_inserted"]) == ("SUCCESS", n)


def test_a_feed_is_parsed_once(spark, tmp_dir):
    """The stored records carry counts and names; nothing after them reads the text."""
    path = _file(tmp_dir, '{"fincode": 1, "name": "a"}', "{broken")
    records, counts = staged(read_feed(spark, path, form="lines"), spark)
    assert (counts["records"], counts["malformed"]) == (1, 1)
    mi, _ = records_input(records, SPEC)
    plan = mi.feed._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan text" not in plan and "from_json" not in plan


def test_spec_from_a_table(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS board_t (FINCODE int, yrc int, serialno int, dirtype_id int, dirname varchar(20)) USING parquet")
    try:
        spec = TableSpec.from_table(spark, "board_t", name="Board")
        assert spec.pk == ("fincode", "yrc", "serialno", "dirtype_id") and spec.lengths == {"dirname": 20}
        assert spec.dtype("fincode").simpleString() == "int"
    finally:
        spark.sql("DROP TABLE board_t")


def test_broken_bytes_are_replaced(spark, tmp_dir, place):
    store, log = place
    path = os.path.join(tmp_dir, "b.txt")
    with open(path, "wb") as f:
        f.write(b'{"fincode": 1, "name": "a\xffb", "flag": "A"}\n{"fincode": 2, "name": "\xc3\xa9", "flag": "A"}\n')
    assert ingest(spark, path, SPEC, store, log, now=NOON)["rows_inserted"] == 2
    assert {r.name for r in store.read().collect()} == {"a�b", "é"}


def test_error_text_is_kept_whole(spark, tmp_dir, place, monkeypatch):
    store, log = place
    text = "first line\n" + "x" * 2000

    def broken(*_, **__):
        raise RuntimeError(text)

    monkeypatch.setattr(store, "read", broken)
    r = ingest(spark, _file(tmp_dir, '{"fincode": 1, "name": "a", "flag": "A"}'), SPEC, store, log, now=NOON)
    assert r["status"] == "FAILED" and r["error_message"] == text == log.table().first().error_message


def test_empty_file_and_empty_folder_of_lines(spark, tmp_dir, place):
    store, log = place
    for text in ([""], ["", "  ", "]"]):
        assert ingest(spark, _file(tmp_dir, *text), SPEC, store, log, now=NOON)["status"] == "EMPTY"
    open(os.path.join(tmp_dir, "zero.txt"), "w").close()
    assert ingest(spark, os.path.join(tmp_dir, "zero.txt"), SPEC, store, log, now=NOON)["status"] == "EMPTY"
    assert store.current_version() is None
