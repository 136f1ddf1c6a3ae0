"""Line and document parsing rules."""

import os


from tidemark.plans import fixtures as FX
from tidemark.sources.feeds import classify_lines, parse_documents, parse_lines, read_feed


def _kinds(spark, lines):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, pos long")
    c = classify_lines(df).orderBy("pos").collect()
    return [(r["kind"], None if r["rows"] is None else [dict(x) for x in r["rows"]]) for r in c]


def test_line_shapes(spark):
    out = _kinds(spark, [
        '{"Table":[{"a":"1"},{"a":"2"}]}',    # one-line envelope -> 2 rows
        '{"Table":[{"a":3},',                 # first wrapped line
        '  {"a":4},',                         # middle line, padded
        '{"a":5}]}',                          # last wrapped line
        '[{"a":6},{"a":7}]',                  # bare array -> 2 rows
        '', '  ', ']', '[', '{', '[]}',  # skipped (NBSP counts as blank)
        '{"bad": ',                           # malformed
        '{"a":1} garbage',                    # trailing text: malformed
        '{"a":1},{"b":2}',                    # two values on one line: malformed
        '{"Message":"No Data Found"}',        # status envelope
        '{"error":"Internal ERROR occurred"}',
        '{"a":[1,2]}',                        # nested array ending in ]} parses as is
        "{'a':1}",                            # single quotes are not JSON
    ])
    kinds = [k for k, _ in out]
    assert kinds == ["rows", "rows", "rows", "rows", "rows", "skip", "skip", "skip", "skip", "skip", "skip",
                     "malformed", "malformed", "malformed", "message", "message", "rows", "malformed"]
    assert out[0][1] == [{"a": "1"}, {"a": "2"}]
    assert out[1][1] == [{"a": "3"}] and out[2][1] == [{"a": "4"}] and out[3][1] == [{"a": "5"}]
    assert out[4][1] == [{"a": "6"}, {"a": "7"}]
    assert out[16][1] == [{"a": "[1,2]"}]


def test_nation_payload_fixture(spark):
    """29 lines left after blank/bracket lines, 3 malformed, 1 envelope, 25 rows, sum of regionkeys 50."""
    n = FX.table(spark, "/root/testdata/sf0.001", "nation")
    from pyspark.sql import functions as F
    j = F.to_json(F.struct(F.col("n_nationkey").alias(" N_NationKey "), F.col("n_name").alias("N_NAME"),
                           "n_regionkey", F.lit("x").alias("extra_col"), F.lit("A").alias("Flag")))
    k = F.col("n_nationkey")
    data = n.select(F.when(k == 0, F.concat(F.lit('{"Table":['), j, F.lit(",")))
                    .when(k == 24, F.concat(j, F.lit("]}"))).otherwise(F.concat(j, F.lit(","))).alias("value"),
                    (k * 10).alias("pos"))
    extra = spark.createDataFrame(
        [('{"n_nationkey": ', 15), ("{bad", 55), ('{"x": [1,', 95), ("", 25), ("  ", 65), ("\t", 105),
         ("]", 35), ("]", 75), ("]", 115), ('{"Message":"No Data Found"}', 45)], "value string, pos long")
    feed = parse_lines(data.unionByName(extra))
    st = feed.stats().first()
    assert st["lines"] - st["skipped"] == 29
    assert (st["malformed"], st["status_messages"], st["records"]) == (3, 1, 25)
    from tidemark.plans.ingest import records_input
    from tidemark.spec import TableSpec
    from pyspark.sql import types as T
    spec = TableSpec.of("nation_t", T.StructType([T.StructField("n_nationkey", T.IntegerType()),
                                                  T.StructField("n_name", T.StringType()),
                                                  T.StructField("n_regionkey", T.IntegerType())]), pk=["n_nationkey"])
    mi, plan = records_input(feed.records, spec)
    assert plan.extra == [] and plan.missing == []        # unknown keys never reach the plan …
    from tidemark.operators.normalize import observed_columns
    known = {*spec.columns, "flag"}
    assert {r["column_name"] for r in observed_columns(feed.records, spec).collect()} - known == {"extra_col"}     # … but a frame
    assert mi.feed.agg(F.sum("n_regionkey")).first()[0] == 50


def test_read_feed_files_in_order_and_document_fallback(spark, tmp_dir):
    d = os.path.join(tmp_dir, "feed")
    os.makedirs(d)
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write('{"Table":[{"k":"1","v":"x"},\n{"k":"1","v":"y"}]}\n')
    with open(os.path.join(d, "b.txt"), "w") as f:
        f.write('{"k":"1","v":"z"}\n')
    feed = read_feed(spark, d)
    rows = [r["rec"]["v"] for r in feed.records.orderBy("pos").collect()]
    assert rows == ["x", "y", "z"]
    doc = os.path.join(tmp_dir, "doc.json")
    with open(doc, "w") as f:
        f.write('{\n  "Table": [\n    {"k": "1"},\n    {"k": "2"}\n  ]\n}\n')
    feed = read_feed(spark, doc)                       # no line parses -> whole document
    assert sorted(r["rec"]["k"] for r in feed.records.collect()) == ["1", "2"]


def test_documents_strict_and_messages(spark):
    docs = spark.createDataFrame([('{"Table":[{"a":"1"}]}', 1), ('[{"a":"2"}]', 2),
                                  ('[{"Message":"No record found"}]', 3), ('{"Error":"error"}', 4),
                                  ('{"Table": 5}', 5)], "value string, pos long")
    loose = {r["pos"]: r["kind"] for r in parse_documents(docs).lines.collect()}
    assert loose == {1: "rows", 2: "rows", 3: "message", 4: "message", 5: "malformed"}
    strict = {r["pos"]: r["kind"] for r in parse_documents(docs, strict=True).lines.collect()}
    assert strict[1] == "rows" and strict[2] == "malformed"


def test_conform_with_varying_key_order(spark):
    """The key-position shortcut falls back to the map when a record's order differs."""
    from pyspark.sql import types as T
    from tidemark.plans.ingest import records_input
    from tidemark.spec import TableSpec
    lines = spark.createDataFrame([('{"k":"1","a":"x","b":"2"}', 1), ('{"b":"3","k":"2","a":"y"}', 2),
                                   ('{"a":"z","k":"3"}', 3), ('{"k":"4","b":"5","a":"w","extra":"e"}', 4)],
                                  "value string, pos long")
    spec = TableSpec.of("t", T.StructType([T.StructField("k", T.LongType()), T.StructField("a", T.StringType()),
                                           T.StructField("b", T.IntegerType())]), pk=["k"])
    mi, _ = records_input(parse_lines(lines).records, spec)
    got = {r["k"]: (r["a"], r["b"]) for r in mi.feed.collect()}
    assert got == {1: ("x", 2), 2: ("y", 3), 3: ("z", None), 4: ("w", 5)}


def test_last_wins_across_file_splits(spark, tmp_dir):
    """One file read as many splits: arrival order (file, block start, row id) still
    puts later lines after earlier ones, so keep-last picks the last line."""
    from pyspark.sql import types as T
    from tidemark.operators.merge import winners
    from tidemark.plans.ingest import records_input
    from tidemark.spec import TableSpec
    p = os.path.join(tmp_dir, "big.txt")
    with open(p, "w") as f:
        for i in range(6000):
            f.write('{"k": "%d", "v": "%d", "flag": "A"}\n' % (i % 7, i))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        feed = read_feed(spark, p, form="lines")
        assert feed.lines.rdd.getNumPartitions() > 10
        spec = TableSpec.of("t", T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType()),
                                               T.StructField("flag", T.StringType())]), pk=["k"])
        mi, _ = records_input(feed.records, spec)
        got = {r["k"]: r["v"] for r in winners(mi).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {k: max(i for i in range(6000) if i % 7 == k) for k in range(7)}
