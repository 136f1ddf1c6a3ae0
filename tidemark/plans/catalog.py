"""Registered queries: one per operator, each over whole benchmark tables, with
the equivalent DuckDB SQL.  Used by ``__spark_entry__`` and the tests."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.coerce import coerce, is_fractional
from tidemark.functions.dates import elapsed_seconds, format_ddmmyyyy, parse_ddmmyyyy
from tidemark.functions.names import period_year, strip_local_prefix
from tidemark.functions.text import blank_to_null, clean_text
from tidemark.operators import manifest as MF
from tidemark.operators import merge as M
from tidemark.operators import runlog as RL
from tidemark.operators import slices as SL
from tidemark.operators.dedup import keep_last
from tidemark.operators.normalize import observed_columns, raw_columns
from tidemark.operators.quality import audit_structure, expected_columns, rejected_keys, split_rejects
from tidemark.plans import bulk as B
from tidemark.plans import fixtures as FX
from tidemark.plans.ingest import RunLog, apply_feed, frame_input, ingest, records_input
from tidemark.session import scratch_path
from tidemark.sources.feeds import classify_lines, of_kind, parse_lines, read_feed
from tidemark.sources.store import SnapshotStore
from tidemark.spec import CONSOLIDATED_PAIRS, PRIMARY_KEYS, TableSpec, feed_groups_rows, norm_name
from tidemark.streaming.merge_stream import MergeStream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# --------------------------------------------------------------------------- F1: change feed on orders

F1_COLS = "k, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, flag"


def _f1(spark, sf, spec=FX.ORDERS_SPEC, feed=None):
    feed = FX.f1_feed(spark, sf) if feed is None else feed
    mi, _ = frame_input(feed, spec, order="seq")
    return mi


def _f1_classified(spark, sf, mi=None, **kw):
    mi = mi or _f1(spark, sf)
    return mi, M.merge(FX.f1_target(spark, sf), mi, **kw)


_W = f"""WITH {FX.F1_FEED_SQL},
w AS (
  SELECT * FROM feed WHERE k IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq DESC) = 1
),
c AS (
  SELECT w.*, CASE
      WHEN w.flag = 'D' THEN CASE WHEN t.k IS NULL THEN 'no_match' ELSE 'delete' END
      WHEN w.flag IN ('A', 'O') THEN CASE
          WHEN t.k IS NULL THEN 'insert'
          WHEN w.o_custkey IS DISTINCT FROM t.o_custkey OR w.o_orderstatus IS DISTINCT FROM t.o_orderstatus
            OR w.o_totalprice IS DISTINCT FROM t.o_totalprice OR w.o_orderpriority IS DISTINCT FROM t.o_orderpriority
            OR w.flag IS DISTINCT FROM t.flag THEN 'update'
          ELSE 'unchanged' END
      ELSE 'ignored' END AS action
  FROM w LEFT JOIN tgt t ON w.k = t.k
)"""

_COUNTS_SQL = """
SELECT CAST(r.received AS BIGINT) AS received,
       CAST(SUM(CASE WHEN action = 'insert' THEN 1 ELSE 0 END) AS BIGINT) AS inserted,
       CAST(SUM(CASE WHEN action = 'update' THEN 1 ELSE 0 END) AS BIGINT) AS updated,
       CAST(SUM(CASE WHEN action = 'delete' THEN 1 ELSE 0 END) AS BIGINT) AS deleted,
       CAST(SUM(CASE WHEN action = 'unchanged' THEN 1 ELSE 0 END) AS BIGINT) AS unchanged,
       CAST(r.received - SUM(CASE WHEN action IN ('insert', 'update', 'delete', 'unchanged') THEN 1 ELSE 0 END) AS BIGINT) AS rejected,
       CAST(r.null_pk AS BIGINT) AS null_pk,
       CAST(r.received - r.null_pk - COUNT(*) AS BIGINT) AS duplicates,
       CAST(SUM(CASE WHEN action = 'no_match' THEN 1 ELSE 0 END) AS BIGINT) AS unmatched_deletes,
       CAST(SUM(CASE WHEN action = 'ignored' THEN 1 ELSE 0 END) AS BIGINT) AS unknown_flags
FROM c, (SELECT COUNT(*) AS received, COUNT(*) FILTER (WHERE k IS NULL) AS null_pk FROM feed) r
GROUP BY r.received, r.null_pk
"""


@register("scan_rows", f"WITH {FX.F1_FEED_SQL} SELECT {F1_COLS}, seq FROM feed")
def q_scan_rows(spark, sf):
    mi = _f1(spark, sf)
    return mi.feed.select(*F1_COLS.split(", "), F.col("pos").alias("seq"))


@register("dedup_keep_last", f"{_W} SELECT {F1_COLS}, seq FROM w")
def q_dedup_keep_last(spark, sf):
    mi = _f1(spark, sf)
    return M.winners(mi).select(*F1_COLS.split(", "), F.col("pos").alias("seq"))


@register("reject_missing_pk", f"WITH {FX.F1_FEED_SQL} SELECT o_custkey, flag, seq FROM feed WHERE k IS NULL")
def q_reject_missing_pk(spark, sf):
    _, rejected = split_rejects(_f1(spark, sf).feed, ["k"])
    return rejected.select("o_custkey", "flag", F.col("pos").alias("seq"))


@register("agg_rejected_keys", f"""WITH {FX.F1_FEED_SQL}
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS o_custkey FROM feed WHERE k IS NULL AND o_custkey IS NOT NULL""")
def q_agg_rejected_keys(spark, sf):
    _, rejected = split_rejects(_f1(spark, sf).feed, ["k"])
    log = RunLog(spark, scratch_path(spark, "run-log"))
    log.reject(1, rejected_keys(rejected, "o_custkey"))
    return log.rejected_keys().select(F.col("key").alias("o_custkey"))


@register("pk_not_null", f"""WITH {FX.F1_FEED_SQL}
SELECT CAST(COUNT(*) FILTER (WHERE k IS NOT NULL) AS BIGINT) AS accepted,
       CAST(COUNT(*) FILTER (WHERE k IS NULL) AS BIGINT) AS rejected FROM feed""")
def q_pk_not_null(spark, sf):
    return _f1(spark, sf).feed.agg(F.count_if(F.col("k").isNotNull()).alias("accepted"),
                                   F.count_if(F.col("k").isNull()).alias("rejected"))


@register("filter_flag", f"""{_W}
SELECT k, CASE WHEN flag = 'D' THEN 'delete' WHEN flag IN ('A', 'O') THEN 'upsert' ELSE 'ignored' END AS flag_class FROM w""")
def q_filter_flag(spark, sf):
    w = M.winners(_f1(spark, sf))
    fl = F.col("flag")
    return w.select("k", F.when(fl == "D", "delete").when(fl.isin("A", "O"), "upsert").otherwise("ignored").alias("flag_class"))


@register("agg_flag_counts", f"""{_W}
SELECT CAST(COUNT(*) FILTER (WHERE flag = 'D') AS BIGINT) AS delete_candidates,
       CAST(COUNT(*) FILTER (WHERE flag IN ('A', 'O')) AS BIGINT) AS upsert_candidates FROM w""")
def q_agg_flag_counts(spark, sf):
    w = M.winners(_f1(spark, sf))
    return w.agg(F.count_if(F.col("flag") == "D").alias("delete_candidates"),
                 F.count_if(F.col("flag").isin("A", "O")).alias("upsert_candidates"))


@register("classify_changes", f"{_W} SELECT k, flag, action FROM c")
def q_classify_changes(spark, sf):
    mi, c = _f1_classified(spark, sf)
    return M.changes(c, mi).select("k", "flag", "action")


@register("agg_change_counts", f"{_W} {_COUNTS_SQL}")
def q_agg_change_counts(spark, sf):
    _, c = _f1_classified(spark, sf, counted=True, how="right_outer")
    return M.change_summary(c)


_STATE_SQL = f"""{_W}
SELECT {F1_COLS} FROM tgt WHERE k NOT IN (SELECT k FROM w WHERE flag IN ('A', 'O', 'D'))
UNION ALL
SELECT {F1_COLS} FROM w WHERE flag IN ('A', 'O')"""


@register("merge_apply", _STATE_SQL)
def q_merge_apply(spark, sf):
    mi, c = _f1_classified(spark, sf)
    return M.next_state(c, mi)


@register("union_snapshot", f"""{_W}
SELECT t.k, COALESCE(c.action, 'keep') AS origin FROM tgt t LEFT JOIN c ON t.k = c.k
WHERE COALESCE(c.action, 'keep') NOT IN ('delete')
UNION ALL SELECT k, action FROM c WHERE action = 'insert'""")
def q_union_snapshot(spark, sf):
    _, c = _f1_classified(spark, sf)
    keep = F.col("_action").isin("keep", "insert", "update", "unchanged") | \
        ((F.col("_action") == "ignored") & F.col("_t").isNotNull())
    return c.where(keep).select("k", F.col("_action").alias("origin"))


@register("merge_delete", f"""{_W}
SELECT {F1_COLS} FROM tgt WHERE k NOT IN (SELECT k FROM w WHERE flag = 'D')""")
def q_merge_delete(spark, sf):
    mi, c = _f1_classified(spark, sf)
    kept = c.where((F.col("_action") != "delete") & F.col("_t").isNotNull())
    return kept.select("k", *[F.col("_t").getField(x).alias(x) for x in F1_COLS.split(", ")[1:]])


@register("join_delete", f"{_W} SELECT k FROM c WHERE action = 'delete'")
def q_join_delete(spark, sf):
    return M.deleted_keys(FX.f1_target(spark, sf), M.winners(_f1(spark, sf)), ["k"])


@register("merge_upsert", f"{_W} SELECT {F1_COLS}, action FROM c WHERE action IN ('insert', 'update')")
def q_merge_upsert(spark, sf):
    mi, c = _f1_classified(spark, sf)
    return M.changes(c, mi).where(F.col("action").isin("insert", "update")).select(*F1_COLS.split(", "), "action")


@register("join_upsert_match", f"""{_W}
SELECT k, action <> 'insert' AS matched FROM c WHERE flag IN ('A', 'O')""")
def q_join_upsert_match(spark, sf):
    mi, c = _f1_classified(spark, sf)
    return (c.where(F.col("_s").isNotNull() & F.col("_s.flag").isin("A", "O"))
             .select("k", F.col("_t").isNotNull().alias("matched")))


@register("merge_partial", f"""{_W}
SELECT k, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, flag FROM tgt
WHERE k NOT IN (SELECT k FROM w WHERE flag IN ('A', 'O', 'D'))
UNION ALL
SELECT w.k, w.o_custkey, w.o_orderstatus, w.o_totalprice, t.o_orderpriority, w.flag
FROM w LEFT JOIN tgt t ON w.k = t.k WHERE w.flag IN ('A', 'O')""")
def q_merge_partial(spark, sf):
    feed = FX.f1_feed(spark, sf).drop("o_orderpriority")
    mi = _f1(spark, sf, feed=feed)
    c = M.merge(FX.f1_target(spark, sf), mi)
    return M.next_state(c, mi)


_BULK = f"""WITH {FX.F1_FEED_SQL},
bfeed AS (SELECT * FROM feed),
ao AS (SELECT * FROM bfeed WHERE flag IN ('A', 'O') AND k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq DESC) = 1),
d AS (SELECT DISTINCT k FROM bfeed WHERE flag = 'D' AND k IS NOT NULL)"""


@register("merge_bulk", f"""{_BULK}
SELECT {F1_COLS} FROM tgt WHERE k NOT IN (SELECT k FROM d) AND k NOT IN (SELECT k FROM ao)
UNION ALL SELECT {F1_COLS} FROM ao""")
def q_merge_bulk(spark, sf):
    mi = _f1(spark, sf)
    c = M.merge(FX.f1_target(spark, sf), mi, mode="bulk")
    return M.next_state(c, mi)


@register("agg_bulk_counts", f"""{_BULK}
SELECT CAST(COUNT(*) AS BIGINT) AS received,
       CAST(COUNT(*) FILTER (WHERE flag IN ('A', 'O')) AS BIGINT) AS upserted,
       CAST(COUNT(*) FILTER (WHERE flag = 'D') AS BIGINT) AS deleted,
       CAST(COUNT(*) FILTER (WHERE flag IN ('A', 'O', 'D')) AS BIGINT) AS rows_loaded,
       CAST(COUNT(*) FILTER (WHERE flag IN ('A', 'O') AND k IS NULL) AS BIGINT) AS null_key_upserts
FROM bfeed""")
def q_agg_bulk_counts(spark, sf):
    return M.bulk_summary(_f1(spark, sf)).drop("bad_rows")


@register("distinct_on_key", f"{_BULK} SELECT k, flag, seq FROM ao")
def q_distinct_on_key(spark, sf):
    mi = _f1(spark, sf)
    w = keep_last(mi.feed.drop("_bad"), ["k"], "pos", where=F.col("flag").isin("A", "O") & F.col("k").isNotNull())
    return w.select("k", "flag", F.col("pos").alias("seq"))


@register("flag_normalize", f"{_W} {_COUNTS_SQL}")
def q_flag_normalize(spark, sf):
    feed = FX.f1_feed(spark, sf).withColumn("flag", F.concat(F.lit(" "), F.lower("flag"), F.lit("  ")))
    mi = _f1(spark, sf, feed=feed)
    return M.change_summary(M.merge(FX.f1_target(spark, sf), mi, counted=True, how="right_outer"))


_W_NOFLAG = _W.replace("SELECT * FROM feed WHERE k IS NOT NULL",
                       "SELECT * REPLACE ('A' AS flag) FROM feed WHERE k IS NOT NULL")


@register("flag_default", f"""{_W_NOFLAG}
SELECT CAST(r.received AS BIGINT) AS received,
       CAST(SUM(CASE WHEN action = 'insert' THEN 1 ELSE 0 END) AS BIGINT) AS inserted,
       CAST(SUM(CASE WHEN action = 'update' THEN 1 ELSE 0 END) AS BIGINT) AS updated,
       CAST(SUM(CASE WHEN action = 'unchanged' THEN 1 ELSE 0 END) AS BIGINT) AS unchanged
FROM c, (SELECT COUNT(*) AS received FROM feed) r GROUP BY r.received""")
def q_flag_default(spark, sf):
    feed = FX.f1_feed(spark, sf).drop("flag")
    mi = _f1(spark, sf, feed=feed)
    s = M.change_summary(M.merge(FX.f1_target(spark, sf), mi, counted=True, how="right_outer"))
    return s.select("received", "inserted", "updated", "unchanged")


# --------------------------------------------------------------------------- readers: payload lines on customer


CUST_TYPED = "c_custkey, c_name, c_nationkey, c_acctbal, flag"
_CUST_TYPED_SQL = f"SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'A' AS flag FROM customer"


def _cust_feed(spark, sf):
    return parse_lines(FX.customer_lines(spark, sf))


def _cust_files(spark, sf):
    """The same lines, written as files and read back by the feed reader."""
    return read_feed(spark, FX.write_customer_lines(spark, sf, scratch_path(spark, "customer-lines")), form="lines")


def _cust_documents(spark, sf, strict=False):
    path = FX.write_customer_documents(spark, sf, scratch_path(spark, "customer-documents"))
    return read_feed(spark, path, form="document", strict=strict)


def _cust_typed(spark, sf, feed=None):
    feed = feed or _cust_feed(spark, sf)
    mi, plan = records_input(feed.records, FX.CUSTOMER_SPEC)
    return mi, plan


@register("scan_ndjson", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(7 AS INTEGER) AS n_keys FROM customer""")
def q_scan_ndjson(spark, sf):
    r = _cust_files(spark, sf).records
    return r.select(F.col("rec").getItem(" C_CustKey ").alias("c_custkey"), F.size("rec").alias("n_keys"))


@register("scan_envelope", f"{_CUST_TYPED_SQL} WHERE c_custkey % 71 = 0")
def q_scan_envelope(spark, sf):
    feed = _cust_files(spark, sf)         # every line is parsed; the records of envelope lines are kept
    envelope = F.col("value").startswith('{"Table":[') & F.col("value").endswith("]}")
    rows = feed.lines.select(F.posexplode_outer(F.when(envelope, F.col("rows"))).alias("elem", "rec"), "pos")
    records = rows.where(F.col("rec").isNotNull()).select(F.struct(F.col("pos").alias("line"), "elem").alias("pos"), "rec")
    mi, _ = records_input(records, FX.CUSTOMER_SPEC)
    return mi.feed.select(*CUST_TYPED.split(", "))


@register("project_to_schema", _CUST_TYPED_SQL)
def q_project_to_schema(spark, sf):
    mi, _ = _cust_typed(spark, sf)
    return mi.feed.select(*CUST_TYPED.split(", "))


@register("dedup_columns", "SELECT c_custkey, c_name FROM customer")
def q_dedup_columns(spark, sf):
    mi, _ = _cust_typed(spark, sf)
    return mi.feed.select("c_custkey", "c_name")


@register("flag_normalize_text", "SELECT c_custkey, 'A' AS flag FROM customer")
def q_flag_normalize_text(spark, sf):
    mi, _ = _cust_typed(spark, sf)
    return mi.feed.select("c_custkey", "flag")


_KEYS_SQL = """SELECT v.raw_name, v.column_name, CAST(COUNT(*) AS BIGINT) AS records
FROM customer, (VALUES (' C_CustKey ', 'c_custkey'), ('C_NAME', 'c_name'), ('c_nationkey', 'c_nationkey'),
                       ('Account Balance', 'c_acctbal'), ('c_name ', 'c_name'), ('extra_col', 'extra_col'),
                       ('Flag', 'flag')) v(raw_name, column_name)
{where} GROUP BY v.raw_name, v.column_name"""


@register("norm_columns", _KEYS_SQL.format(where=""))
def q_norm_columns(spark, sf):
    return observed_columns(_cust_feed(spark, sf).records, FX.CUSTOMER_SPEC).select("raw_name", "column_name", "records")


@register("rename_columns", _KEYS_SQL.format(where="WHERE v.raw_name = 'Account Balance'"))
def q_rename_columns(spark, sf):
    records = _cust_feed(spark, sf).records
    _, plan = records_input(records, FX.CUSTOMER_SPEC)
    renamed = [(raw, name) for raw, name in plan.kept if norm_name(raw) != name]
    names = spark.createDataFrame(renamed, "raw_name string, column_name string")
    return raw_columns(records).join(F.broadcast(names), "raw_name").select("raw_name", "column_name", "records")


@register("filter_malformed", "SELECT c_custkey * 10 + 1 AS pos FROM customer WHERE c_custkey % 97 = 0")
def q_filter_malformed(spark, sf):
    return _cust_feed(spark, sf).malformed.select("pos")


@register("filter_envelope", "SELECT c_custkey * 10 + 4 AS pos FROM customer WHERE c_custkey % 79 = 0")
def q_filter_envelope(spark, sf):
    return of_kind(classify_lines(FX.customer_lines(spark, sf)), "message").select("pos")


@register("agg_malformed", """SELECT
  CAST(COUNT(*) + COUNT(*) FILTER (WHERE c_custkey % 97 = 0) + COUNT(*) FILTER (WHERE c_custkey % 89 = 0)
       + COUNT(*) FILTER (WHERE c_custkey % 83 = 0) + COUNT(*) FILTER (WHERE c_custkey % 79 = 0) AS BIGINT) AS lines,
  CAST(COUNT(*) FILTER (WHERE c_custkey % 89 = 0) + COUNT(*) FILTER (WHERE c_custkey % 83 = 0) AS BIGINT) AS skipped,
  CAST(COUNT(*) FILTER (WHERE c_custkey % 97 = 0) AS BIGINT) AS malformed,
  CAST(COUNT(*) FILTER (WHERE c_custkey % 79 = 0) AS BIGINT) AS status_messages,
  CAST(COUNT(*) AS BIGINT) AS records
FROM customer""")
def q_agg_malformed(spark, sf):
    return _cust_feed(spark, sf).stats()


_AUDIT_SQL = """SELECT DISTINCT 'customer_feed' AS table_name, 'MISMATCH' AS structure, 'extra_col' AS extra,
       'c_mktsegment' AS missing, true AS warning FROM customer"""


def _audit(spark, sf):
    obs = observed_columns(_cust_feed(spark, sf).records, FX.CUSTOMER_SPEC)
    return audit_structure(obs, expected_columns(spark, [FX.CUSTOMER_SPEC]))


@register("audit_structure", _AUDIT_SQL)
def q_audit_structure(spark, sf):
    a = _audit(spark, sf)
    return a.select("table_name", "structure", F.array_join("extra", ",").alias("extra"),
                    F.array_join("missing", ",").alias("missing"), "warning")


@register("columns_extra", "SELECT DISTINCT 'customer_feed' AS table_name, 'extra_col' AS column_name FROM customer")
def q_columns_extra(spark, sf):
    return _audit(spark, sf).select("table_name", F.explode("extra").alias("column_name"))


@register("columns_missing", "SELECT DISTINCT 'customer_feed' AS table_name, 'c_mktsegment' AS column_name FROM customer")
def q_columns_missing(spark, sf):
    return _audit(spark, sf).select("table_name", F.explode("missing").alias("column_name"))


_PHONE_SPEC = TableSpec.of("customer_by_phone", T.StructType([
    T.StructField("c_phone", T.StringType()), T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType())]), pk=["c_phone"])


@register("validate_feed", """SELECT DISTINCT 'error' AS level,
  'customer_by_phone: missing PK columns: [''c_phone'']' AS message FROM customer""")
def q_validate_feed(spark, sf):
    root = scratch_path(spark, "phone-feed")
    log = RunLog(spark, f"{root}/log")
    ingest(spark, FX.write_customer_lines(spark, sf, f"{root}/in"), _PHONE_SPEC,
           SnapshotStore(spark, f"{root}/state", _PHONE_SPEC), log, form="lines")
    return log.table().where("status = 'VALIDATION_FAILED'").select(F.lit("error").alias("level"), F.col("error_message").alias("message"))


@register("scan_document", _CUST_TYPED_SQL)
def q_scan_document(spark, sf):
    mi, _ = _cust_typed(spark, sf, _cust_documents(spark, sf))
    return mi.feed.select(*CUST_TYPED.split(", "))


@register("scan_large_document", f"WITH {FX.F1_FEED_SQL} SELECT {F1_COLS} FROM feed")
def q_scan_large_document(spark, sf):
    """The whole change feed on orders as one document, read in splits."""
    folder = FX.write_large_document(spark, sf, scratch_path(spark, "large-document"))
    mi, _ = records_input(read_feed(spark, folder, form="document", split_over=1 << 14).records, FX.ORDERS_SPEC)
    return mi.feed.select(*F1_COLS.split(", "))


@register("scan_table_json", f"{_CUST_TYPED_SQL} WHERE (c_custkey // 200) % 2 = 0")
def q_scan_table_json(spark, sf):
    mi, _ = _cust_typed(spark, sf, _cust_documents(spark, sf, strict=True))
    return mi.feed.select(*CUST_TYPED.split(", "))


# --------------------------------------------------------------------------- F3: coercion on lineitem

@register("blank_to_null", f"""WITH {FX.F3_SQL}
SELECT l_orderkey, l_linenumber, CASE WHEN trim(x) = '' THEN NULL ELSE x END AS x FROM x""")
def q_blank_to_null(spark, sf):
    t = FX.lineitem_text(spark, sf)
    return t.select("l_orderkey", "l_linenumber", blank_to_null("x").alias("x"))


@register("null_tokens", f"""WITH {FX.F3_SQL}
SELECT l_orderkey, l_linenumber,
       CASE WHEN lower(trim(x)) IN ('', 'nan', 'none', '<na>') THEN NULL ELSE trim(x) END AS x FROM x""")
def q_null_tokens(spark, sf):
    t = FX.lineitem_text(spark, sf)
    return t.select("l_orderkey", "l_linenumber", clean_text("x").alias("x"))


_NUM = "TRY_CAST(trim(x) AS DOUBLE)"


@register("coerce_number", f"""WITH {FX.F3_SQL}
SELECT l_orderkey, l_linenumber, {_NUM} AS x_num FROM x""")
def q_coerce_number(spark, sf):
    t = FX.lineitem_text(spark, sf)
    v, _ = coerce("x", T.DoubleType())
    return t.select("l_orderkey", "l_linenumber", v.alias("x_num"))


@register("coerce_int", f"""WITH {FX.F3_SQL}
SELECT l_orderkey, l_linenumber,
       CASE WHEN {_NUM} = floor({_NUM}) THEN CAST({_NUM} AS BIGINT) END AS x_int,
       COALESCE({_NUM} <> floor({_NUM}), false) AS fractional FROM x""")
def q_coerce_int(spark, sf):
    t = FX.lineitem_text(spark, sf)
    v, _ = coerce("x", T.LongType(), on_fraction="null")
    return t.select("l_orderkey", "l_linenumber", v.alias("x_int"), is_fractional("x").alias("fractional"))


@register("agg_coerce_counts", f"""WITH {FX.F3_SQL}
SELECT CAST(COUNT(*) AS BIGINT) AS rows_total,
       CAST(COUNT(*) FILTER (WHERE {_NUM} = floor({_NUM})) AS BIGINT) AS integral,
       CAST(COUNT({_NUM}) AS BIGINT) AS numeric,
       CAST(COUNT(*) FILTER (WHERE {_NUM} <> floor({_NUM})) AS BIGINT) AS fractional FROM x""")
def q_agg_coerce_counts(spark, sf):
    t = FX.lineitem_text(spark, sf)
    vi, bad = coerce("x", T.LongType(), on_fraction="fail")
    vd, _ = coerce("x", T.DoubleType())
    return t.agg(F.count(F.lit(1)).alias("rows_total"), F.count(vi).alias("integral"),
                 F.count(vd).alias("numeric"), F.count_if(bad).alias("fractional"))


@register("coerce_timestamp", f"""WITH {FX.F3_SQL}
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_orderkey % 17 = 0 OR l_orderkey % 19 = 0 THEN NULL
            WHEN l_orderkey % 23 = 0 OR l_orderkey % 29 = 0 THEN CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP)
            ELSE CAST(l_shipdate AS TIMESTAMP) END AS ts,
       l_orderkey % 17 = 0 OR l_orderkey % 19 = 0 AS bad FROM x""")
def q_coerce_timestamp(spark, sf):
    t = FX.lineitem_text(spark, sf)
    k, at = F.col("l_orderkey"), F.col("l_shipdate")
    txt = (F.when(k % 17 == 0, F.lit("not a date")).when(k % 19 == 0, F.date_format(at, "yyyy"))
           .when(k % 23 == 0, F.date_format(at, "yyyyMMdd")).when(k % 29 == 0, F.date_format(at, "MM/dd/yyyy"))
           .otherwise(at.cast("string")))
    v, bad = coerce(txt, T.TimestampNTZType())
    return t.select("l_orderkey", "l_linenumber", v.alias("ts"), bad.alias("bad"))


@register("check_length", "SELECT p_partkey, length(p_name) > 30 AS too_long FROM part")
def q_check_length(spark, sf):
    p = FX.table(spark, sf, "part")
    _, bad = coerce("p_name", T.StringType(), max_len=30)
    return p.select("p_partkey", F.coalesce(bad, F.lit(False)).alias("too_long"))


_LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
            "l_returnflag, l_linestatus, l_shipdate")


@register("lineitem_keep_last", f"""SELECT {_LI_COLS} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
  {', '.join(c + ' DESC' for c in FX.LINEITEM_ORDER)}) = 1""")
def q_lineitem_keep_last(spark, sf):
    li = FX.table(spark, sf, "lineitem")
    w = keep_last(li.withColumn("pos", F.struct(*FX.LINEITEM_ORDER)), ["l_orderkey", "l_linenumber"], "pos")
    return w.drop("pos")


# --------------------------------------------------------------------------- F4: run log on events

@register("run_status", f"WITH {FX.F4_SQL} SELECT id, feed_name, requested_date, status FROM runs")
def q_run_status(spark, sf):
    facts = FX.run_facts(spark, sf)
    status = RL.run_status("received", "error", "validation_error", "http_status", "table_found")
    return facts.select("id", "feed_name", "requested_date", F.when(F.col("open"), "STARTED").otherwise(status).alias("status"))


@register("business_date", f"WITH {FX.F4_SQL} SELECT id, started_at, requested_date FROM runs")
def q_business_date(spark, sf):
    return FX.run_events(spark, sf).select("id", "started_at", "requested_date")


@register("runlog_latest", f"""WITH {FX.F4_SQL}
SELECT id, status, CASE WHEN status = 'STARTED' THEN NULL ELSE started_at + INTERVAL 90 SECOND END AS finished_at
FROM runs""")
def q_runlog_latest(spark, sf):
    return RL.latest_runs(FX.run_log_events(spark, sf)).select("id", "status", "finished_at")


@register("run_times", f"""WITH {FX.F4_SQL}
SELECT id, strftime(requested_date, '%d%m%Y') AS day_text, requested_date AS day,
       CASE WHEN status <> 'STARTED' THEN CAST(90 AS BIGINT) END AS seconds FROM runs""")
def q_run_times(spark, sf):
    log = RL.latest_runs(FX.run_log_events(spark, sf)).withColumn("day_text", format_ddmmyyyy("requested_date"))
    return log.select("id", "day_text", parse_ddmmyyyy("day_text").alias("day"), elapsed_seconds("started_at", "finished_at").alias("seconds"))


@register("agg_run_count", f"""WITH {FX.F4_SQL}
SELECT feed_name, requested_date, status, CAST(COUNT(*) AS BIGINT) AS runs FROM runs GROUP BY ALL""")
def q_agg_run_count(spark, sf):
    return RL.run_counts(FX.run_events(spark, sf))


@register("join_missed_runs", f"""WITH {FX.F4_SQL},
span AS (SELECT min(requested_date) AS a, max(requested_date) AS z FROM runs),
expected AS (SELECT feed_name, CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS requested_date
             FROM (SELECT DISTINCT feed_name FROM runs UNION SELECT 'feed_absent'), span)
SELECT feed_name, requested_date FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM runs d WHERE d.feed_name = e.feed_name AND d.requested_date = e.requested_date
                  AND d.status IN ('SUCCESS', 'STARTED', 'NO_CONTENT'))""")
def q_join_missed_runs(spark, sf):
    runs = FX.run_events(spark, sf)
    first, last = runs.agg(F.min("requested_date"), F.max("requested_date")).first()
    feeds = runs.select("feed_name").distinct().unionByName(spark.createDataFrame([("feed_absent",)], "feed_name string"))
    return RL.missed_runs(RL.expected_runs(feeds, first, last), runs)


@register("agg_run_summary", f"""WITH {FX.F4_SQL}
SELECT requested_date, CAST(COUNT(*) AS BIGINT) AS runs,
       CAST(COUNT(*) FILTER (WHERE status IN ('SUCCESS', 'NO_CONTENT')) AS BIGINT) AS succeeded,
       COALESCE(string_agg(DISTINCT feed_name, ',' ORDER BY feed_name)
                FILTER (WHERE status NOT IN ('SUCCESS', 'NO_CONTENT')), '') AS not_succeeded
FROM runs GROUP BY requested_date""")
def q_agg_run_summary(spark, sf):
    return RL.run_summary(FX.run_events(spark, sf), ["requested_date"])


def _stored_log(spark, sf):
    log = RunLog(spark, scratch_path(spark, "run-log"))
    log.append_events(FX.run_log_events(spark, sf))
    return log


_F4_AT = _dt.datetime.fromisoformat(FX.F4_NOW)

_ABANDON_SQL = f"""WITH {FX.F4_SQL}
SELECT id, 'ABANDONED' AS status, 'Service restarted or terminated unexpectedly' AS error_message,
       TIMESTAMP '{FX.F4_NOW}' AS finished_at FROM runs WHERE status = 'STARTED'"""


@register("close_stale", _ABANDON_SQL)
def q_close_stale(spark, sf):
    log = _stored_log(spark, sf)
    log.abandon(_F4_AT)
    return log.table().where("status = 'ABANDONED'").select("id", "status", "error_message", "finished_at")


@register("sink_runlog", f"""WITH {FX.F4_SQL}
SELECT id, feed_name, requested_date,
       CASE WHEN status = 'STARTED' THEN 'ABANDONED' ELSE status END AS status,
       CASE WHEN status = 'STARTED' THEN TIMESTAMP '{FX.F4_NOW}' ELSE started_at + INTERVAL 90 SECOND END AS finished_at
FROM runs""")
def q_sink_runlog(spark, sf):
    log = _stored_log(spark, sf)
    log.abandon(_F4_AT)
    return log.table().select("id", "feed_name", "requested_date", "status", "finished_at")


@register("expire_rows", f"""WITH {FX.F4_SQL}
SELECT id FROM runs WHERE started_at < TIMESTAMP '{FX.F4_NOW}' - INTERVAL {FX.F4_RETENTION_DAYS} DAY""")
def q_expire_rows(spark, sf):
    log = _stored_log(spark, sf)
    log.expire(_F4_AT, FX.F4_RETENTION_DAYS)
    return FX.run_events(spark, sf).select("id").join(log.table().select("id"), "id", "left_anti")


# --------------------------------------------------------------------------- F5: report-file manifest

@register("scan_manifest", f"WITH {FX.F5_SQL} SELECT path, file_name, fincode, report_type, year_end FROM parsed")
def q_scan_manifest(spark, sf):
    return MF.parse_listing(FX.report_listing(spark, sf)).select("path", "file_name", "fincode", "report_type", "year_end")


@register("manifest_catalog", f"""WITH {FX.F5_SQL}
SELECT file_name, fincode, report_type, year_end, doc_id % 3 <> 0 AS is_new FROM parsed""")
def q_manifest_catalog(spark, sf):
    c = MF.catalog(FX.report_listing(spark, sf), FX.report_manifest(spark, sf))
    return c.select("file_name", "fincode", "report_type", "year_end", "is_new")


@register("join_missing_files", f"WITH {FX.F5_SQL} SELECT file_name FROM parsed WHERE doc_id % 3 <> 0")
def q_join_missing_files(spark, sf):
    return MF.new_files(FX.report_listing(spark, sf), FX.report_manifest(spark, sf)).select("file_name")


@register("agg_manifest_counts", f"""WITH {FX.F5_SQL}
SELECT CAST(COUNT(*) AS BIGINT) AS received, CAST(COUNT(*) FILTER (WHERE doc_id % 3 = 0) AS BIGINT) AS unchanged,
       CAST(COUNT(*) FILTER (WHERE doc_id % 3 <> 0 AND doc_id % 13 <> 0) AS BIGINT) AS inserted,
       CAST(COUNT(*) FILTER (WHERE doc_id % 3 <> 0 AND doc_id % 13 = 0) AS BIGINT) AS rejected,
       CASE WHEN COUNT(*) = 0 THEN 'NO_CONTENT' WHEN COUNT(*) FILTER (WHERE doc_id % 3 <> 0 AND doc_id % 13 = 0) > 0
            THEN 'WARNINGS' ELSE 'SUCCESS' END AS status FROM parsed""")
def q_agg_manifest_counts(spark, sf):
    found = MF.catalog(FX.report_listing(spark, sf), FX.report_manifest(spark, sf))
    return MF.manifest_counts(found, failed=F.col("doc_id") % 13 == 0)


def _manifest_after_replace(spark, sf):
    listing, manifest = FX.report_listing(spark, sf), FX.report_manifest(spark, sf)
    new = MF.new_files(listing, manifest)
    recs = MF.records_for(new, MF.local_location(period_year("year_end"), F.col("file_name")),
                          at=F.lit(FX.F5_AT).cast("timestamp"))
    mi, _ = frame_input(recs.withColumn("pos", F.col("fincode").cast("bigint")), MF.SPEC, order="pos")
    return M.next_state(M.merge(manifest, mi, change_test=False), mi)


_MANIFEST_COLS = "fincode, report_type, year_end, file_name, azure_blob_url, status, error_message"


@register("merge_replace", f"""WITH {FX.F5_SQL}
SELECT {_MANIFEST_COLS} FROM manifest WHERE status = 'SUCCESS'
UNION ALL
SELECT fincode, report_type, year_end, file_name,
       'local://data/digital_reports/' || substr(CAST(year_end AS VARCHAR), 1, 4) || '/' || file_name,
       'SUCCESS', CAST(NULL AS VARCHAR) FROM parsed WHERE doc_id % 3 <> 0""")
def q_merge_replace(spark, sf):
    return _manifest_after_replace(spark, sf).select(*_MANIFEST_COLS.split(", "))


_PENDING_SQL = f"""WITH {FX.F5_SQL}
SELECT fincode, report_type, year_end, file_name FROM parsed WHERE doc_id % 3 <> 0 OR doc_id % 2 = 1"""


@register("manifest_pending", _PENDING_SQL)
def q_manifest_pending(spark, sf):
    return MF.pending(_manifest_after_replace(spark, sf)).select("fincode", "report_type", "year_end", "file_name")


@register("manifest_local_paths", f"""WITH {FX.F5_SQL}
SELECT file_name, replace(azure_blob_url, 'local://', '') AS path FROM manifest
WHERE status = 'SUCCESS' AND azure_blob_url LIKE 'local://%'""")
def q_manifest_local_paths(spark, sf):
    return MF.pending(FX.report_manifest(spark, sf)).select("file_name", strip_local_prefix("azure_blob_url").alias("path"))


_MOVED_AT = "2024-03-05 06:07:08"


@register("update_location", f"""WITH {FX.F5_SQL}
SELECT fincode, report_type, year_end,
       CASE WHEN status = 'SUCCESS' AND azure_blob_url LIKE 'local://%' THEN 'blob://' || substr(CAST(year_end AS VARCHAR), 1, 4) || '/' || file_name
            ELSE azure_blob_url END AS azure_blob_url, status,
       CASE WHEN status = 'SUCCESS' AND azure_blob_url LIKE 'local://%' THEN '{_MOVED_AT}' ELSE '{FX.F5_AT}' END AS downloaded_at
FROM manifest""")
def q_update_location(spark, sf):
    to = F.concat(F.lit("blob://"), period_year("year_end"), F.lit("/"), F.col("file_name"))
    moved = MF.update_location(FX.report_manifest(spark, sf), to, F.lit(_MOVED_AT).cast("timestamp"))
    return moved.select("fincode", "report_type", "year_end", "azure_blob_url", "status",
                        F.date_format("downloaded_at", "yyyy-MM-dd HH:mm:ss").alias("downloaded_at"))


@register("manifest_failed", f"""WITH {FX.F5_SQL}
SELECT fincode, report_type, year_end, file_name, '' AS azure_blob_url, 'FAILED' AS status, substr(repeat('transfer failed ', 50), 1, 500) AS error_message
FROM parsed WHERE doc_id % 3 <> 0 AND doc_id % 13 = 0""")
def q_manifest_failed(spark, sf):
    new = MF.new_files(FX.report_listing(spark, sf), FX.report_manifest(spark, sf)).where(F.col("doc_id") % 13 == 0)
    return MF.failed_records(new, F.repeat(F.lit("transfer failed "), 50)).drop("downloaded_at")


# --------------------------------------------------------------------------- F6: streams; snapshots


def _events_by_stream(spark, sf, parts, files_per_trigger):
    """The events arrive in ``parts`` slices; after each the stream is started again
    from its checkpoints and takes what is new."""
    root = scratch_path(spark, "event-stream")
    stream = MergeStream(spark, f"{root}/stream", FX.EVENTS_SPEC, order_col="event_id", newer_than="event_id", feed_name="events")
    for part in range(parts):
        if parts == 1:
            FX.write_event_feed(spark, sf, f"{root}/in")
        else:
            FX.write_event_file(spark, sf, f"{root}/in", part, parts)
        stream.run(f"{root}/in", files_per_trigger)
    return stream


@register("stream_merge", """SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
       arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def q_stream_merge(spark, sf):
    return _events_by_stream(spark, sf, parts=1, files_per_trigger=1).current()


@register("stream_counts", """WITH e AS (SELECT user_id, event_id, event_id % 3 AS batch_id FROM events),
w AS (SELECT batch_id, user_id, max(event_id) AS event_id, count(*) AS n FROM e GROUP BY ALL),
s AS (SELECT *, max(event_id) OVER (PARTITION BY user_id ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS had FROM w)
SELECT batch_id, 'SUCCESS' AS status, CAST(sum(n) AS BIGINT) AS rows_received,
       CAST(count(*) FILTER (WHERE had IS NULL) AS BIGINT) AS rows_inserted,
       CAST(count(*) FILTER (WHERE event_id > had) AS BIGINT) AS rows_updated,
       CAST(sum(n) - count(*) FILTER (WHERE had IS NULL OR event_id > had) AS BIGINT) AS rows_rejected
FROM s GROUP BY batch_id""")
def q_stream_counts(spark, sf):
    return _events_by_stream(spark, sf, parts=3, files_per_trigger=100_000).log().select(
        "batch_id", "status", "rows_received", "rows_inserted", "rows_updated", "rows_rejected")


# --------------------------------------------------------------------------- slices of a feed


_SLICE = 1000

_ORDER = "o_orderkey % 7, o_orderkey"


@register("chunk_rows", f"""WITH n AS (SELECT row_number() OVER (ORDER BY {_ORDER}) - 1 AS line FROM orders)
SELECT CAST(line // {_SLICE} AS BIGINT) AS slice, CAST(min(line) AS BIGINT) AS first_line, CAST(max(line) AS BIGINT) AS last_line,
       CAST(COUNT(*) AS BIGINT) AS rows FROM n GROUP BY 1""")
def q_chunk_rows(spark, sf):
    o = FX.table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 7).alias("wave"))
    return SL.slice_summary(SL.row_numbers(o, "wave", "o_orderkey"), _SLICE)


# F1 in waves: first every order's own row, then the second rows, the key-less rows, the rows
# with an unknown flag.  Keys come back in later slices, some after their delete.
_SLICES_SQL = f"""WITH RECURSIVE {FX.F1_FEED_SQL},
n AS (SELECT *, (row_number() OVER (ORDER BY seq % 10, seq) - 1) // {_SLICE // 4} AS slice FROM feed),
w AS (SELECT * FROM n WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY slice, k ORDER BY seq % 10 DESC, seq DESC) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY slice) AS turn FROM w),
step AS (
  SELECT t.k, 0 AS turn, CAST(NULL AS BIGINT) AS slice, CAST(NULL AS VARCHAR) AS action, true AS there,
         o_custkey, o_orderstatus, o_totalprice, o_orderpriority, t.flag
  FROM tgt t
  UNION ALL
  SELECT DISTINCT o.k, 0, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), false, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
  FROM o WHERE o.k NOT IN (SELECT k FROM tgt)
  UNION ALL
  SELECT o.k, o.turn, o.slice,
         CASE WHEN o.flag = 'D' THEN CASE WHEN s.there THEN 'delete' ELSE 'no_match' END
              WHEN o.flag IN ('A', 'O') THEN CASE WHEN NOT s.there THEN 'insert'
                WHEN o.o_custkey IS DISTINCT FROM s.o_custkey OR o.o_orderstatus IS DISTINCT FROM s.o_orderstatus OR o.o_totalprice IS DISTINCT FROM s.o_totalprice
                  OR o.o_orderpriority IS DISTINCT FROM s.o_orderpriority OR o.flag IS DISTINCT FROM s.flag THEN 'update' ELSE 'unchanged' END
              ELSE 'ignored' END,
         CASE WHEN o.flag = 'D' THEN false WHEN o.flag IN ('A', 'O') THEN true ELSE s.there END,
         CASE WHEN o.flag IN ('A', 'O') THEN o.o_custkey ELSE s.o_custkey END, CASE WHEN o.flag IN ('A', 'O') THEN o.o_orderstatus ELSE s.o_orderstatus END,
         CASE WHEN o.flag IN ('A', 'O') THEN o.o_totalprice ELSE s.o_totalprice END, CASE WHEN o.flag IN ('A', 'O') THEN o.o_orderpriority ELSE s.o_orderpriority END,
         CASE WHEN o.flag IN ('A', 'O') THEN o.flag ELSE s.flag END
  FROM step s JOIN o ON o.k = s.k AND o.turn = s.turn + 1
),
a AS (SELECT slice, count(*) FILTER (WHERE action = 'insert') AS inserted, count(*) FILTER (WHERE action = 'update') AS updated,
             count(*) FILTER (WHERE action = 'delete') AS deleted, count(*) FILTER (WHERE action = 'unchanged') AS unchanged
      FROM step WHERE turn > 0 GROUP BY slice),
c AS (SELECT n.slice, n.received, coalesce(inserted, 0) AS inserted, coalesce(updated, 0) AS updated, coalesce(deleted, 0) AS deleted,
             coalesce(unchanged, 0) AS unchanged
      FROM (SELECT slice, count(*) AS received FROM n GROUP BY slice) n LEFT JOIN a ON a.slice = n.slice)"""


def _f1_slices(spark, sf):
    feed = FX.f1_feed(spark, sf).withColumn("wave", F.col("seq") % 10)
    numbered = SL.row_numbers(feed, "wave", "seq", name="line").drop("wave", "seq")
    mi = _f1(spark, sf, feed=numbered.withColumnRenamed("line", "seq"))
    mi = replace(mi, feed=mi.feed.withColumn("slice", SL.slice_of("pos", _SLICE // 4)))
    return SL.slice_totals(SL.slice_changes(mi, FX.f1_target(spark, sf)))


_SLICE_COUNTS = "received, inserted, updated, deleted, unchanged"


@register("agg_slice_counts", f"""{_SLICES_SQL}
SELECT CAST(slice AS BIGINT) AS slice, CAST(received AS BIGINT) AS received, inserted, updated, deleted, unchanged,
       CAST(received - inserted - updated - deleted - unchanged AS BIGINT) AS rejected FROM c""")
def q_agg_slice_counts(spark, sf):
    return _f1_slices(spark, sf)


@register("agg_feed_totals", f"""{_SLICES_SQL}
SELECT CAST(COUNT(*) AS BIGINT) AS slices, {', '.join(f'CAST(SUM({x}) AS BIGINT) AS {x}' for x in _SLICE_COUNTS.split(', '))},
       CAST(SUM(received - inserted - updated - deleted - unchanged) AS BIGINT) AS rejected FROM c""")
def q_agg_feed_totals(spark, sf):
    return SL.feed_totals(_f1_slices(spark, sf))


def _f1_store(spark, sf):
    store = SnapshotStore(spark, scratch_path(spark, "orders-snapshot"), FX.ORDERS_SPEC)
    store.write(FX.f1_target(spark, sf))
    return store


@register("scan_target", f"WITH {FX.F1_FEED_SQL} SELECT {F1_COLS} FROM tgt")
def q_scan_target(spark, sf):
    return _f1_store(spark, sf).read()


@register("sink_snapshot", _STATE_SQL)
def q_sink_snapshot(spark, sf):
    store = _f1_store(spark, sf)
    res = apply_feed(_f1(spark, sf), store)
    if res.status != "SUCCESS":
        raise RuntimeError(f"merge failed: {res.error}")
    return store.read()


# --------------------------------------------------------------------------- bulk files: lookup, pairs, report


_STEMS = [f for f, _ in feed_groups_rows()] + ["digital_reports", "Unknown_feed"]


def _feed_listing(spark, sf):
    d = FX.table(spark, sf, "documents")
    i = F.col("doc_id")
    st = F.element_at(F.array(*[F.lit(s) for s in _STEMS]), (i % len(_STEMS) + 1).cast("int"))
    st = F.when(i % 2 == 1, F.upper(st)).otherwise(st)
    ext = F.when(i % 7 == 0, F.lit(".json")).otherwise(F.lit(".txt"))
    return d.select(F.concat(F.lit("/feeds/"), i.cast("string"), F.lit("/"), st, ext).alias("path"))


def _sql_list(xs):
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


_LISTING_SQL = f"""files AS (
  SELECT '/feeds/' || CAST(doc_id AS VARCHAR) || '/' || stem || CASE WHEN doc_id % 7 = 0 THEN '.json' ELSE '.txt' END AS path,
         stem || CASE WHEN doc_id % 7 = 0 THEN '.json' ELSE '.txt' END AS file_name, doc_id % 7 = 0 AS is_json,
         lower(stem) AS stem_key
  FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN upper({_sql_list(_STEMS)}[doc_id % {len(_STEMS)} + 1])
                            ELSE {_sql_list(_STEMS)}[doc_id % {len(_STEMS)} + 1] END AS stem FROM documents) s
),
known AS (SELECT unnest({_sql_list(list(PRIMARY_KEYS))}) AS table_key)"""


def _folder(spark, sf):
    return FX.write_feed_folder(spark, sf, scratch_path(spark, "feed-folder"))


# a file of a slice exists when its slice has rows
_SLICE_ROWS = " UNION ALL ".join(
    f"SELECT '{FX.spelled(t, i)}' AS file, COUNT(*) AS n FROM {t.split('_')[0]} WHERE {key} % {n} = {i}" for t, (key, n) in FX.FOLDER_SLICES.items() for i in range(n))
_FOLDER_SQL = f"""{FX.F1_FEED_SQL},
slices AS ({_SLICE_ROWS}),
ffiles AS (SELECT * FROM (VALUES {FX.folder_files_sql()}) v(file, table_name) WHERE file NOT IN (SELECT file FROM slices WHERE n = 0))"""


@register("scan_feed_dir", f"WITH {_FOLDER_SQL} SELECT file AS file_name, table_name FROM ffiles")
def q_scan_feed_dir(spark, sf):
    return B.feed_folder(spark, _folder(spark, sf), B.catalogue(spark, list(FX.FOLDER_SPECS))).select("file_name", "table_name")


@register("join_table_lookup", f"""WITH {_LISTING_SQL}
SELECT f.path, k.table_key AS table_name FROM files f LEFT JOIN known k ON f.stem_key = k.table_key WHERE NOT f.is_json""")
def q_join_table_lookup(spark, sf):
    files = B.lookup_tables(B.feed_files(_feed_listing(spark, sf)), B.catalogue(spark))
    return files.select("path", "table_name")


_PAIRS_SQL = "(VALUES " + ", ".join(f"('{a.lower()}', '{b}')" for a, b in CONSOLIDATED_PAIRS.items()) + ") p(k, pair_table)"


@register("join_pair", f"""WITH {_LISTING_SQL}
SELECT f.path, p.pair_table FROM files f JOIN known k ON f.stem_key = k.table_key JOIN {_PAIRS_SQL} ON p.k = k.table_key
WHERE NOT f.is_json""")
def q_join_pair(spark, sf):
    files = B.lookup_tables(B.feed_files(_feed_listing(spark, sf)), B.catalogue(spark))
    return B.with_pairs(files.where(F.col("table_name").isNotNull()), spark).select("path", "pair_table")


_ORDERS_FILES = [FX.spelled("orders_cdc", i) for i in range(5)]
_REPORT_SQL = f"""WITH {_FOLDER_SQL}
SELECT '{FX.spelled("customer_feed", 0)}' AS file, 'customer_feed' AS table_name, 'MISMATCH' AS structure, 'PASS' AS load,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM customer) AS rows_loaded,
       'extra_json=[''extra_col''] | missing_json=[''c_mktsegment'']' AS notes
UNION ALL SELECT '{FX.spelled("customer_feed", 1)}', 'customer_feed', 'PARSE ERROR', 'SKIP', CAST(0 AS BIGINT), 'JSON missing valid ''Table'' array'
UNION ALL SELECT '{_ORDERS_FILES[0]}', 'orders_cdc', 'MATCH', 'FAIL', CAST(0 AS BIGINT),
       'NULL primary key in ' || (SELECT CAST(COUNT(*) AS VARCHAR) FROM feed WHERE k IS NULL AND flag IN ('A', 'O')) || ' add/update rows'
UNION ALL SELECT '{_ORDERS_FILES[1]}', 'orders_cdc', 'MATCH', 'PASS', (SELECT CAST(COUNT(*) AS BIGINT) FROM feed WHERE k % 4 = 1 AND flag IN ('A', 'O', 'D')), ''
UNION ALL SELECT '{_ORDERS_FILES[2]}', 'orders_cdc', 'MATCH', 'PASS', (SELECT CAST(COUNT(*) AS BIGINT) FROM feed WHERE k % 4 = 2 AND flag IN ('A', 'O', 'D')), ''
UNION ALL SELECT '{_ORDERS_FILES[3]}', 'orders_cdc', 'MISMATCH', 'PASS', (SELECT CAST(COUNT(*) AS BIGINT) FROM feed WHERE k % 8 = 1),
       'missing_json=[''o_custkey'', ''o_orderpriority'', ''o_orderstatus'']'
UNION ALL SELECT '{_ORDERS_FILES[4]}', 'orders_cdc', 'MISMATCH', 'FAIL', CAST(0 AS BIGINT),
       'missing_json=[''flag''] | Required ''flag'' column not present for table: orders_cdc'
UNION ALL SELECT file, table_name, 'MATCH', 'PASS', CAST(n AS BIGINT), '' FROM slices JOIN ffiles USING (file)
UNION ALL SELECT 'unknown.txt', 'NOT FOUND', 'SKIP', 'SKIP', CAST(0 AS BIGINT), 'No matching table'"""


def _loaded_folder(spark, sf, stores=None):
    return B.load_folder(spark, _folder(spark, sf), FX.FOLDER_SPECS, stores)


# the files that load, in the order of their names
_LOADED = sorted((_ORDERS_FILES[i], i) for i in (1, 2, 3))
_FOLDED_SQL = f"""WITH RECURSIVE {FX.F1_FEED_SQL},
rows_in AS (
  SELECT {[f for f, _ in _LOADED].index(_ORDERS_FILES[1]) + 1} AS turn, k, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, flag, seq, false AS part FROM feed WHERE k % 4 = 1
  UNION ALL SELECT {[f for f, _ in _LOADED].index(_ORDERS_FILES[2]) + 1}, k, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, flag, seq, false FROM feed WHERE k % 4 = 2
  UNION ALL SELECT {[f for f, _ in _LOADED].index(_ORDERS_FILES[3]) + 1}, k, NULL, NULL, o_totalprice + 50, NULL, CASE WHEN k % 3 = 0 THEN 'O' ELSE 'D' END, seq, true FROM feed WHERE k % 8 = 1
),
per_file AS (SELECT turn, k, bool_or(flag = 'D') AS d, arg_max(struct_pack(o_custkey, o_orderstatus, o_totalprice, o_orderpriority, flag, part), seq) FILTER (WHERE flag IN ('A', 'O')) AS w
             FROM rows_in GROUP BY turn, k),
state AS (
  SELECT 0 AS turn, k, struct_pack(o_custkey, o_orderstatus, o_totalprice, o_orderpriority, flag) AS r FROM tgt
  UNION ALL SELECT DISTINCT 0, k, NULL FROM per_file WHERE k NOT IN (SELECT k FROM tgt)
  UNION ALL
  SELECT s.turn + 1, s.k, CASE
      WHEN p.k IS NULL THEN s.r
      WHEN p.w IS NULL THEN CASE WHEN p.d THEN NULL ELSE s.r END
      WHEN p.w.part AND NOT p.d THEN struct_pack(o_custkey := s.r.o_custkey, o_orderstatus := s.r.o_orderstatus, o_totalprice := p.w.o_totalprice, o_orderpriority := s.r.o_orderpriority, flag := p.w.flag)
      ELSE struct_pack(o_custkey := p.w.o_custkey, o_orderstatus := p.w.o_orderstatus, o_totalprice := p.w.o_totalprice, o_orderpriority := p.w.o_orderpriority, flag := p.w.flag) END
  FROM state s LEFT JOIN per_file p ON p.k = s.k AND p.turn = s.turn + 1 WHERE s.turn < 3
)
SELECT k, r.o_custkey AS o_custkey, r.o_orderstatus AS o_orderstatus, r.o_totalprice AS o_totalprice, r.o_orderpriority AS o_orderpriority, r.flag AS flag
FROM state WHERE turn = 3 AND r IS NOT NULL"""


@register("merge_folder", _FOLDED_SQL)
def q_merge_folder(spark, sf):
    store = _f1_store(spark, sf)
    _loaded_folder(spark, sf, {"orders_cdc": store})
    return store.read()


@register("feed_report", _REPORT_SQL)
def q_feed_report(spark, sf):
    return _loaded_folder(spark, sf)


@register("agg_load_summary", f"""WITH r AS ({_REPORT_SQL})
SELECT CAST(COUNT(*) FILTER (WHERE notes LIKE '%extra_json=%') AS BIGINT) AS structure_warnings,
       CAST(COUNT(*) FILTER (WHERE load = 'PASS') AS BIGINT) AS load_pass,
       CAST(COUNT(*) FILTER (WHERE load = 'FAIL' OR structure = 'PARSE ERROR') AS BIGINT) AS load_fail,
       CAST(SUM(rows_loaded) AS BIGINT) AS rows_loaded FROM r""")
def q_agg_load_summary(spark, sf):
    return B.load_summary(_loaded_folder(spark, sf))


@register("sink_report", f"""WITH r AS ({_REPORT_SQL})
SELECT * FROM r
UNION ALL
SELECT 'TOTAL', NULL, NULL,
       CAST(COUNT(*) FILTER (WHERE load = 'PASS') AS VARCHAR) || '/' || CAST(COUNT(*) FILTER (WHERE load IN ('PASS', 'FAIL')) AS VARCHAR),
       CAST(SUM(rows_loaded) AS BIGINT), NULL FROM r""")
def q_sink_report(spark, sf):
    return B.report_with_totals(_loaded_folder(spark, sf))


@register("union_rejects", f"WITH {FX.F1_FEED_SQL} SELECT o_custkey, flag, seq FROM feed WHERE k IS NULL")
def q_union_rejects(spark, sf):
    feed = FX.f1_feed(spark, sf)
    parts = []
    for half in (0, 1):            # two chunks of one feed; their rejects accumulate
        mi = _f1(spark, sf, feed=feed.where(F.col("seq") % 2 == half))
        parts.append(split_rejects(mi.feed, ["k"])[1])
    return parts[0].unionByName(parts[1]).select("o_custkey", "flag", F.col("pos").alias("seq"))
