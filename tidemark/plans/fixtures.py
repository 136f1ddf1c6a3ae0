"""Change feeds derived from the benchmark tables (all Spark, all whole tables).

F1: a change feed on ``orders`` applied to a target made from ``orders``.
F3: text-typed numbers on ``lineitem``.
F4: a run log on ``events``.
F5: report file names on ``documents``.
F6: ordered micro-batches on ``events``.
Payload lines (readers) are built from ``customer`` and ``nation``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.spec import TableSpec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------- F1

ORDERS_SPEC = TableSpec.of(
    "orders_cdc",
    T.StructType([
        T.StructField("k", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
        T.StructField("flag", T.StringType()),
    ]),
    pk=["k"],
)

ORDERS_NOFLAG_SPEC = TableSpec.of(
    "orders_cdc_noflag",
    T.StructType([f for f in ORDERS_SPEC.schema.fields if f.name != "flag"]),
    pk=["k"],
)


def f1_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderkey") % 10 != 9).select(
        F.col("o_orderkey").alias("k"), "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.lit("A").alias("flag"))


def f1_feed(spark: SparkSession, sf_dir: str, with_nullkey: bool = True) -> DataFrame:
    """Feed rows (k, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, flag, seq)."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    base = o.where(key % 3 == 0).select(
        key.alias("k"), "o_custkey", "o_orderstatus",
        F.when(key % 7 == 0, F.col("o_totalprice"))
         .when(key % 5 == 0, F.col("o_totalprice") + 1)
         .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderpriority",
        F.when(key % 7 == 0, "D").when(key % 5 == 0, "O").otherwise("A").alias("flag"),
        (key * 10).alias("seq"))
    dup = o.where(key % 6 == 0).select(
        key.alias("k"), "o_custkey", "o_orderstatus", (F.col("o_totalprice") + 2).alias("o_totalprice"),
        "o_orderpriority", F.lit("O").alias("flag"), (key * 10 + 1).alias("seq"))
    nullkey = o.where(key % 15 == 0).select(
        F.lit(None).cast("bigint").alias("k"), "o_custkey", "o_orderstatus", "o_totalprice",
        "o_orderpriority", F.lit("A").alias("flag"), (key * 10 + 2).alias("seq"))
    badflag = o.where(key % 33 == 0).select(
        key.alias("k"), "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.lit("X").alias("flag"), (key * 10 + 3).alias("seq"))
    parts = [base, dup] + ([nullkey] if with_nullkey else []) + [badflag]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


F1_FEED_SQL = """
feed AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1
              ELSE o_totalprice END AS o_totalprice,
         o_orderpriority,
         CASE WHEN o_orderkey % 7 = 0 THEN 'D' WHEN o_orderkey % 5 = 0 THEN 'O' ELSE 'A' END AS flag,
         o_orderkey * 10 AS seq
  FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 2, o_orderpriority, 'O', o_orderkey * 10 + 1
  FROM orders WHERE o_orderkey % 6 = 0
  UNION ALL
  SELECT CAST(NULL AS BIGINT), o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 'A', o_orderkey * 10 + 2
  FROM orders WHERE o_orderkey % 15 = 0
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 'X', o_orderkey * 10 + 3
  FROM orders WHERE o_orderkey % 33 = 0
),
tgt AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 'A' AS flag
  FROM orders WHERE o_orderkey % 10 <> 9
)"""


# --------------------------------------------------------------------------- payload lines on customer

CUSTOMER_SPEC = TableSpec.of(
    "customer_feed",
    T.StructType([
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
        T.StructField("flag", T.StringType()),
    ]),
    pk=["c_custkey"],
    renames={"account balance": "c_acctbal"},
)

# Record keys as a vendor sends them: padded / mixed-case key, a duplicate name
# (the first spelling wins), a vendor name renamed by the spec, an extra column.
_REC = ("struct(c_custkey AS ` C_CustKey `, c_name AS `C_NAME`, c_nationkey, c_acctbal AS `Account Balance`, "
        "upper(c_name) AS `c_name `, 'x' AS extra_col, "
        "CASE WHEN c_custkey % 4 = 0 THEN ' a ' ELSE 'A' END AS `Flag`)")


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload lines (value, pos) made from every customer row, with the shapes a
    feed takes: wrapper prefix/suffix, one-line envelopes, bare arrays, trailing
    commas; plus broken lines, blank lines, bracket lines and status messages."""
    c = table(spark, sf_dir, "customer")
    j = F.expr(f"to_json({_REC})")
    key = F.col("c_custkey")
    data = c.select(
        F.when(key % 71 == 0, F.concat(F.lit('{"Table":['), j, F.lit("]}")))
         .when(key % 73 == 0, F.concat(F.lit("["), j, F.lit("]")))
         .when(key % 1000 == 1, F.concat(F.lit('{"Table":['), j, F.lit(",")))
         .when(key % 1000 == 0, F.concat(j, F.lit("]}")))
         .otherwise(F.concat(F.lit("  "), j, F.lit(","))).alias("value"),
        (key * 10).alias("pos"))
    broken = c.where(key % 97 == 0).select(
        F.concat(F.lit('{"c_custkey": '), key.cast("string"), F.lit(', "c_name": ')).alias("value"),
        (key * 10 + 1).alias("pos"))
    blank = c.where(key % 89 == 0).select(F.lit("   ").alias("value"), (key * 10 + 2).alias("pos"))
    bracket = c.where(key % 83 == 0).select(F.lit("]").alias("value"), (key * 10 + 3).alias("pos"))
    message = c.where(key % 79 == 0).select(F.lit('{"Message":"No Data Found"}').alias("value"),
                                            (key * 10 + 4).alias("pos"))
    return data.unionByName(broken).unionByName(blank).unionByName(bracket).unionByName(message)


# --------------------------------------------------------------------------- F3: text numbers on lineitem

def lineitem_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    x = (F.when(k % 13 == 0, F.lit("n/a"))
         .when(k % 11 == 0, F.lit(""))
         .when(k % 7 == 0, F.concat(F.col("l_linenumber").cast("string"), F.lit(".5")))
         .when(k % 5 == 0, F.concat(F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" ")))
         .otherwise(F.col("l_partkey").cast("string")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", x.alias("x"))


F3_SQL = """x AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
         CASE WHEN l_orderkey % 13 = 0 THEN 'n/a'
              WHEN l_orderkey % 11 = 0 THEN ''
              WHEN l_orderkey % 7 = 0 THEN CAST(l_linenumber AS VARCHAR) || '.5'
              WHEN l_orderkey % 5 = 0 THEN ' ' || CAST(l_partkey AS VARCHAR) || ' '
              ELSE CAST(l_partkey AS VARCHAR) END AS x
  FROM lineitem
)"""

# Order of arrival for the lineitem dedup: every non-key column, so that rows
# that tie are identical and the winner's values are determined.
LINEITEM_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


# --------------------------------------------------------------------------- F4: run log on events

# Fixed "now" for retention and abandoning, so results are reproducible.
F4_NOW = "2024-01-31 00:00:00"
F4_RETENTION_DAYS = 15


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs from events: id, feed_name, requested_date (business date of the local
    start time), status by event type, started_at."""
    from tidemark.functions.dates import business_date
    e = table(spark, sf_dir, "events")
    status = (F.when(F.col("event_type") == "signup", "STARTED")
              .when(F.col("event_type") == "purchase", "SUCCESS")
              .when(F.col("event_type") == "view", "NO_CONTENT")
              .when(F.col("event_type") == "click", "EMPTY")
              .when(F.col("event_type") == "error", "FAILED"))
    return e.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("feed_"), (F.col("user_id") % 7).cast("string")).alias("feed_name"),
        business_date("ts").alias("requested_date"),
        status.alias("status"),
        F.col("ts").alias("started_at"),
    )


def run_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known of each run before it has a status: rows received, error texts, the
    transfer's outcome, whether its table exists, whether it is still open."""
    r = run_events(spark, sf_dir).withColumnRenamed("status", "kind")
    k = F.col("kind")
    return r.select("id", "feed_name", "requested_date", (k == "STARTED").alias("open"), F.lit(True).alias("table_found"),
                    F.when(k == "NO_CONTENT", 204).otherwise(200).alias("http_status"),
                    F.when(k == "SUCCESS", F.col("id") + 1).otherwise(F.lit(0)).alias("received"),
                    F.when(k == "FAILED", "feed failed").alias("error"), F.lit(None).cast("string").alias("validation_error"))


F4_SQL = """runs AS (
  SELECT event_id AS id, 'feed_' || CAST(user_id % 7 AS VARCHAR) AS feed_name,
         CAST(CASE WHEN hour(ts) < 6 THEN CAST(ts AS DATE) - INTERVAL 1 DAY ELSE CAST(ts AS DATE) END AS DATE) AS requested_date,
         CASE event_type WHEN 'signup' THEN 'STARTED' WHEN 'purchase' THEN 'SUCCESS' WHEN 'view' THEN 'NO_CONTENT'
              WHEN 'click' THEN 'EMPTY' WHEN 'error' THEN 'FAILED' END AS status,
         ts AS started_at
  FROM events
)"""


def run_log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only log events: a STARTED event for every run (seq 0) and, for runs
    that finished, a finishing event (seq 1) carrying the final status."""
    r = run_events(spark, sf_dir)
    start = r.select("id", "feed_name", "requested_date", F.lit("STARTED").alias("status"),
                     "started_at", F.lit(None).cast("timestamp_ntz").alias("finished_at"),
                     F.lit(None).cast("string").alias("error_message"), F.lit(0).alias("seq"))
    finish = r.where(F.col("status") != "STARTED").select(
        "id", "feed_name", "requested_date", "status", "started_at",
        (F.col("started_at") + F.expr("INTERVAL 90 SECONDS")).alias("finished_at"),
        F.when(F.col("status") == "FAILED", F.lit("feed failed")).alias("error_message"), F.lit(1).alias("seq"))
    return start.unionByName(finish)


# --------------------------------------------------------------------------- F5: report file names on documents

def report_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, file_name): one file per document in a year folder."""
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    period = (F.lit(202301) + i % 12).cast("string")
    name = (F.when(i % 11 == 0, F.concat(F.lit("notes-"), i.cast("string"), F.lit(".txt")))
            .otherwise(F.concat(i.cast("string"), F.lit("-"), F.substring("lang", 1, 1), F.lit("-"), period,
                                F.when(i % 2 == 0, F.lit(".pdf")).otherwise(F.lit(".PDF")))))
    return d.select(F.concat(F.lit("/reports/"), F.substring(period, 1, 4), F.lit("/"), name).alias("path"),
                    name.alias("file_name"), i.alias("doc_id"))


F5_SQL = """listing AS (
  SELECT '/reports/' || substr(CAST(202301 + doc_id % 12 AS VARCHAR), 1, 4) || '/' || file_name AS path, file_name, doc_id
  FROM (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'notes-' || CAST(doc_id AS VARCHAR) || '.txt'
               ELSE CAST(doc_id AS VARCHAR) || '-' || substr(lang, 1, 1) || '-' || CAST(202301 + doc_id % 12 AS VARCHAR)
                    || CASE WHEN doc_id % 2 = 0 THEN '.pdf' ELSE '.PDF' END END AS file_name
        FROM documents) n
),
parsed AS (
  SELECT path, file_name, doc_id,
         CAST(regexp_extract(file_name, '^(\\d+)-([a-zA-Z0-9]+)-(\\d{6})\\.', 1) AS INTEGER) AS fincode,
         upper(regexp_extract(file_name, '^(\\d+)-([a-zA-Z0-9]+)-(\\d{6})\\.', 2)) AS report_type,
         CAST(regexp_extract(file_name, '^(\\d+)-([a-zA-Z0-9]+)-(\\d{6})\\.', 3) AS INTEGER) AS year_end
  FROM listing WHERE regexp_matches(file_name, '^(\\d+)-([a-zA-Z0-9]+)-(\\d{6})\\.pdf$', 'i')
),
manifest AS (
  SELECT fincode, report_type, year_end, file_name,
         CASE WHEN doc_id % 3 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'blob://2023/' || file_name
                                            ELSE 'local://data/digital_reports/2023/' || file_name END
              ELSE '' END AS azure_blob_url,
         CASE WHEN doc_id % 3 = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
         CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'transfer failed' END AS error_message
  FROM parsed WHERE doc_id % 3 IN (0, 1)
)"""

F5_AT = "2024-02-01 00:00:00"


def report_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing manifest: documents with id % 3 = 0 recorded SUCCESS (half on a
    local fallback location), id % 3 = 1 recorded FAILED."""
    from tidemark.operators.manifest import parse_listing
    p = parse_listing(report_listing(spark, sf_dir))
    i = F.col("doc_id")
    loc = F.when(i % 3 == 0, F.when(i % 2 == 0, F.concat(F.lit("blob://2023/"), F.col("file_name")))
                 .otherwise(F.concat(F.lit("local://data/digital_reports/2023/"), F.col("file_name")))).otherwise(F.lit(""))
    return p.where(i % 3 != 2).select(
        F.col("fincode").cast("int").alias("fincode"), "report_type", F.col("year_end").cast("int").alias("year_end"),
        "file_name", loc.alias("azure_blob_url"),
        F.when(i % 3 == 0, "SUCCESS").otherwise("FAILED").alias("status"),
        F.when(i % 3 != 0, F.lit("transfer failed")).alias("error_message"),
        F.lit(F5_AT).cast("timestamp").alias("downloaded_at"))


# --------------------------------------------------------------------------- F6: ordered micro-batches on events

EVENTS_SPEC = TableSpec.of(
    "events_state",
    T.StructType([
        T.StructField("user_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]),
    pk=["user_id"],
)


def write_customer_lines(spark: SparkSession, sf_dir: str, out_dir: str) -> str:
    """:func:`customer_lines` as text files, as a vendor delivers them."""
    customer_lines(spark, sf_dir).select("value").write.text(out_dir)
    return out_dir


def write_customer_documents(spark: SparkSession, sf_dir: str, out_dir: str, per_file: int = 200) -> str:
    """Documents of ``per_file`` customers, one file each: ``{"Table":[...]}`` for even
    groups, a bare array for odd ones."""
    c = table(spark, sf_dir, "customer").withColumn("file", F.floor(F.col("c_custkey") / per_file))
    docs = c.groupBy("file").agg(F.sort_array(F.collect_list(F.expr(_REC))).alias("rows"))
    opts = {"pretty": "true"}
    doc = F.when(F.col("file") % 2 == 0, F.to_json(F.struct(F.col("rows").alias("Table")), opts)).otherwise(F.to_json("rows", opts))
    docs.select(doc.alias("value"), "file").write.partitionBy("file").text(out_dir)
    return out_dir


def write_event_file(spark: SparkSession, sf_dir: str, out_dir: str, part: int, parts: int) -> None:
    """One of ``parts`` slices of the events (by event id), appended as JSON lines."""
    e = table(spark, sf_dir, "events").where(F.col("event_id") % parts == part)
    (e.select(F.to_json(F.struct("user_id", "event_id", "event_type", "value", F.lit("A").alias("flag"))).alias("value"))
      .write.mode("append").text(out_dir))


def write_event_feed(spark: SparkSession, sf_dir: str, out_dir: str, files: int = 4) -> None:
    """Events as JSON lines, ``files`` files split by event_id range (one job)."""
    e = table(spark, sf_dir, "events")
    (e.repartitionByRange(files, "event_id")
      .select(F.to_json(F.struct("user_id", "event_id", "event_type", "value", F.lit("A").alias("flag"))).alias("value"))
      .write.mode("errorifexists").text(out_dir))


# --------------------------------------------------------------------------- a folder of bulk files

def _flat_spec(name: str, pk: str, cols: dict[str, T.DataType]) -> TableSpec:
    return TableSpec.of(name, T.StructType([T.StructField(c, t) for c, t in {**cols, "flag": T.StringType()}.items()]), pk=[pk])


FOLDER_SPECS = {
    "orders_cdc": ORDERS_SPEC,
    "customer_feed": CUSTOMER_SPEC,
    "supplier_feed": _flat_spec("supplier_feed", "s_suppkey", {"s_suppkey": T.LongType(), "s_name": T.StringType(), "s_acctbal": T.DoubleType()}),
    "part_feed": _flat_spec("part_feed", "p_partkey", {"p_partkey": T.LongType(), "p_name": T.StringType(), "p_size": T.LongType()}),
    "nation_feed": _flat_spec("nation_feed", "n_nationkey", {"n_nationkey": T.LongType(), "n_name": T.StringType()}),
}


def spelled(name: str, i: int) -> str:
    """The i-th spelling of a file name: its letters in upper case by the bits of i."""
    return "".join(c.upper() if i >> j & 1 else c for j, c in enumerate(name)) + ".txt"


#: Files per table of which each holds a slice, by key.
FOLDER_SLICES = {"supplier_feed": ("s_suppkey", 8), "part_feed": ("p_partkey", 8), "nation_feed": ("n_nationkey", 5)}


def _as_documents(rows: DataFrame, folder: str, order: str) -> None:
    """(file, <order>, value) -> one document per file, a record a line.  ``rows`` come from
    stored tables without a shuffle, so their row numbers are the same each time.

    All files are sorted by ranges, so a large document is made by many tasks; its parts are
    then passed on in their order by one task, which holds a line at a time."""
    spark = rows.sparkSession
    rows = rows.select("file", F.col(order).alias("o"), "value", F.monotonically_increasing_id().alias("row"))
    ends = rows.groupBy("file").agg(F.min(F.struct("o", "row")).alias("first"))
    first = F.broadcast(ends.withColumnRenamed("file", "_file"))       # one row per file
    body = rows.join(first, F.col("file").eqNullSafe(F.col("_file"))).select("file", F.lit(1).alias("part"), "o", "row", F.concat(
        F.when(F.struct("o", "row").eqNullSafe(F.col("first")), F.lit("")).otherwise(F.lit(",")), F.col("value")).alias("value"))
    edge = lambda part, text: ends.select("file", F.lit(part).alias("part"), F.lit(0).cast("bigint").alias("o"), F.lit(0).cast("bigint").alias("row"),
                                          F.lit(text).alias("value"))
    out = edge(0, '{"Table":[').unionByName(body).unionByName(edge(2, "]}"))
    place = ["file", "part", "o", "row"]
    parts = folder + "-parts"
    out.repartitionByRange(*place).sortWithinPartitions(*place).select("value", "file").write.partitionBy("file").text(parts)
    _name_files(spark, parts, folder)


def write_large_document(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The change feed on orders as one document on one file."""
    feed = f1_feed(spark, sf_dir)
    value = F.to_json(F.struct("k", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "flag"))
    _as_documents(feed.select(F.lit("orders.json").alias("file"), "seq", value.alias("value")), folder, "seq")
    return folder


def _name_files(spark: SparkSession, parts: str, folder: str) -> None:
    """Spark's files of each ``file=<name>`` folder, one after the other, under that name in ``folder``."""
    from tidemark.session import hadoop_path
    fs, _ = hadoop_path(spark, parts)
    fs.mkdirs(hadoop_path(spark, folder)[1])
    several = {}
    for st in fs.listStatus(hadoop_path(spark, parts)[1]):
        name = st.getPath().getName()
        if name.startswith("file="):
            found = sorted((x.getPath().getName(), x.getPath()) for x in fs.listStatus(st.getPath()) if x.getPath().getName().startswith("part-"))
            if len(found) == 1:
                fs.rename(found[0][1], hadoop_path(spark, f"{folder}/{name[5:]}")[1])
            elif found:
                several[name[5:]] = [x.toString() for _, x in found]

    def put(i: int, name: str) -> None:
        one = reduce(DataFrame.unionAll, [spark.read.option("lineSep", "\n").text(p) for p in several[name]]).coalesce(1)
        one.write.text(f"{parts}-{i}")
        for x in fs.listStatus(hadoop_path(spark, f"{parts}-{i}")[1]):
            if x.getPath().getName().startswith("part-"):
                fs.rename(x.getPath(), hadoop_path(spark, f"{folder}/{name}")[1])

    with ThreadPoolExecutor(8) as pool:         # a file is one job of one task
        list(pool.map(put, range(len(several)), several))


def write_feed_folder(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Thirty files for five tables, and some others: the change feed on orders in five files
    (one with rows without a key, one without a flag, one with two columns only, whose
    keys come again in a later file), customers in vendor names, slices of three
    tables, a broken document, a file without a table, and one that is no feed file."""
    k = F.col("k")
    feed = f1_feed(spark, sf_dir)
    json = lambda *cols: F.to_json(F.struct(*cols))
    cols = ["k", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "flag"]
    clean = feed.where(k.isNotNull())
    parts = [
        feed.where(k.isNull() | (k % 4 == 0)).select(F.lit(spelled("orders_cdc", 0)).alias("file"), F.col("seq").alias("o"), json(*cols).alias("value")),
        clean.where(k % 4 == 1).select(F.lit(spelled("orders_cdc", 1)).alias("file"), F.col("seq").alias("o"), json(*cols).alias("value")),
        clean.where(k % 4 == 2).select(F.lit(spelled("orders_cdc", 2)).alias("file"), F.col("seq").alias("o"), json(*cols).alias("value")),
        clean.where(k % 4 == 3).select(F.lit(spelled("orders_cdc", 4)).alias("file"), F.col("seq").alias("o"), json(*cols[:-1]).alias("value")),
        clean.where(k % 8 == 1).select(F.lit(spelled("orders_cdc", 3)).alias("file"), F.col("seq").alias("o"), json(
            F.col("k").alias(" K"), (F.col("o_totalprice") + 50).alias("O_TotalPrice"), F.when(k % 3 == 0, "O").otherwise("D").alias("Flag")).alias("value")),
        table(spark, sf_dir, "customer").select(F.lit(spelled("customer_feed", 0)).alias("file"), F.col("c_custkey").alias("o"), F.expr(f"to_json({_REC})").alias("value")),
    ]
    for name, (key, n) in FOLDER_SLICES.items():
        spec = FOLDER_SPECS[name]
        t = table(spark, sf_dir, name.split("_")[0])
        i = F.col(key) % n
        file = F.element_at(F.array(*[F.lit(spelled(name, j)) for j in range(n)]), (i + 1).cast("int"))
        parts.append(t.select(file.alias("file"), F.col(key).cast("bigint").alias("o"), json(*[c for c in spec.columns if c != "flag"], F.lit("A").alias("flag")).alias("value")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    _as_documents(rows, folder, "o")
    other = [(spelled("customer_feed", 1), '{"Table": [{"c_custkey": 1}'), ("unknown.txt", '{"Table": []}'), ("notes.json", "{}")]
    spark.createDataFrame(other, "file string, value string").write.partitionBy("file").text(folder + "-others")
    _name_files(spark, folder + "-others", folder)
    return folder


def folder_files_sql() -> str:
    """VALUES (file, table_name): every .txt file of :func:`write_feed_folder`."""
    files = [(spelled("orders_cdc", i), "orders_cdc") for i in range(5)] + [(spelled("customer_feed", i), "customer_feed") for i in range(2)]
    files += [(spelled(t, i), t) for t, (_, n) in FOLDER_SLICES.items() for i in range(n)] + [("unknown.txt", None)]
    return ", ".join(f"('{f}', {'NULL' if t is None else repr(t)})" for f, t in files)
