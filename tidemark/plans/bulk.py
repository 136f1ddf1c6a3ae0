"""Bulk file loading: feed folder -> table lookup -> structure audit -> bulk merge
-> per-file report and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.names import base_name, stem
from tidemark.functions.text import strip
from tidemark.operators.merge import MergeInput
from tidemark.operators.normalize import conform, qcol, resolve_columns
from tidemark.operators.quality import has_null_key
from tidemark.plans.ingest import IngestResult, publish
from tidemark.session import scratch, scratch_path, stored_bytes
from tidemark.sources.feeds import last_values, read_feed
from tidemark.spec import (CONSOLIDATED_PAIRS, FLAG_DELETE, LOAD_ERROR_TEXT_LIMIT, PRIMARY_KEYS, STATUS_SUCCESS, UPSERT_FLAGS, TableSpec)

PARSE_ERROR = "JSON missing valid 'Table' array"


def catalogue(spark: SparkSession, names=None) -> DataFrame:
    """(table_key, table_name): the known tables, keyed by lower-case name."""
    names = list(names) if names is not None else list(PRIMARY_KEYS)
    return spark.createDataFrame([(n.lower(), n) for n in names], "table_key string, table_name string")


def lookup_tables(listing: DataFrame, tables: DataFrame, path: str = "path") -> DataFrame:
    """Feed files -> their table by case-insensitive file stem (NULL: no table).
    The catalogue is a few dozen rows, so it is broadcast."""
    files = listing if "file_name" in listing.columns else listing.select("*", base_name(path).alias("file_name"))
    files = files.select("*", F.lower(stem("file_name")).alias("_stem"))
    return (files.join(F.broadcast(tables), files["_stem"] == tables["table_key"], "left")
            .drop("_stem", "table_key"))


def feed_files(listing: DataFrame, path: str = "path") -> DataFrame:
    """``.txt`` files only."""
    return listing.where(F.col(path).endswith(".txt"))


def pairs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CONSOLIDATED_PAIRS.items()), "table_name string, pair_table string")


def with_pairs(files: DataFrame, spark: SparkSession) -> DataFrame:
    """Files of standalone tables with the consolidated table to run after them."""
    p = pairs(spark).withColumn("_k", F.lower("table_name")).drop("table_name")
    return files.join(F.broadcast(p), F.lower(files["table_name"]) == p["_k"], "inner").drop("_k")


def feed_folder(spark: SparkSession, folder: str, tables: DataFrame) -> DataFrame:
    """file (as readers name it), file_name, table_name (NULL: no such table) and rank (order
    of the names) of the ``.txt`` files of a folder.  Files are listed, not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    files = files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"))
    found = lookup_tables(files.withColumn("file_name", F.url_decode(F.replace("file_name", F.lit("+"), F.lit("%2B")))), tables, "file")
    # a file's rank only has to order the files of one table
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("table_name").orderBy("file_name")))


def _record_shapes(records: DataFrame) -> DataFrame:
    """file, table_name, raw_name, first (where the file has the name first).  Few key lists
    repeat in a file, so they collapse before the shuffle."""
    shapes = records.groupBy("file", "table_name", F.map_keys("rec").alias("ks")).agg(F.min("pos").alias("p"))
    names = shapes.select("file", "table_name", "p", F.posexplode("ks").alias("i", "raw_name"))
    return names.groupBy("file", "table_name", "raw_name").agg(F.min(F.struct("p", "i")).alias("first"))


def file_columns(records: DataFrame, specs: dict[str, TableSpec]) -> DataFrame:
    """file, table_name, raw_name, column_name: which raw name of each file stands for which
    column, by the rules of :func:`resolve_columns` for each file."""
    spark = records.sparkSession
    names = _record_shapes(records).withColumn("norm", F.lower(strip("raw_name")))
    renames = spark.createDataFrame([(t, a, b) for t, s in specs.items() for a, b in s.renames.items()], "table_name string, norm string, renamed string")
    names = names.join(F.broadcast(renames), ["table_name", "norm"], "left")       # a few rows, from the configuration
    spelling = Window.partitionBy("file", "norm").orderBy(F.desc("first"))
    names = names.withColumn("column_name", F.when((F.row_number().over(spelling) == 1) & F.col("renamed").isNotNull(), F.col("renamed")).otherwise(F.col("norm")))
    kept = names.groupBy("file", "table_name", "column_name").agg(F.min_by("raw_name", "first").alias("raw_name"))
    return kept.select("file", "table_name", "raw_name", "column_name")


def _listed(label: str, names: Column) -> Column:
    """``label=['a', 'b']``, or NULL for no names."""
    quoted = F.transform(F.array_sort(names), lambda n: F.when(F.contains(n, F.lit("'")) & ~F.contains(n, F.lit('"')), F.concat(F.lit('"'), n, F.lit('"')))
                         .otherwise(F.concat(F.lit("'"), F.replace(n, F.lit("'"), F.lit("\\'")), F.lit("'"))))
    return F.when(F.size(names) > 0, F.concat(F.lit(label + "=["), F.array_join(quoted, ", "), F.lit("]")))


def file_structure(files: DataFrame, columns: DataFrame, specs: dict[str, TableSpec]) -> DataFrame:
    """file, extra_note, missing_note, has_flag, has_columns of the files that were parsed."""
    expected = files.sparkSession.createDataFrame([(t, c) for t, s in specs.items() for c in s.columns], "table_name string, column_name string")
    want = files.join(F.broadcast(expected), "table_name").select("file", "column_name", F.lit(True).alias("wanted"))
    both = want.join(columns.select("file", "column_name", F.lit(True).alias("there")), ["file", "column_name"], "full_outer")
    name, wanted, there = F.col("column_name"), F.col("wanted").isNotNull(), F.col("there").isNotNull()
    s = both.groupBy("file").agg(F.collect_list(F.when(~wanted & (name != "flag"), name)).alias("extra"), F.collect_list(F.when(~there, name)).alias("missing"),
                                 F.max((name == "flag") & there).alias("has_flag"), F.max(wanted & there).alias("has_columns"))
    return s.select("file", _listed("extra_json", F.col("extra")).alias("extra_note"), _listed("missing_json", F.col("missing")).alias("missing_note"),
                    "has_flag", "has_columns")


def typed_rows(records: DataFrame, columns: DataFrame, spec: TableSpec) -> DataFrame:
    """The records of one table's files as its columns, typed, with flag, pos, ``_bad``,
    ``_file``, ``_rank`` and ``_present`` (the columns the row's file has)."""
    targets = list(dict.fromkeys([*spec.columns, "flag"]))
    raw = columns.where(F.col("column_name").isin(targets)).groupBy("file").agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", "raw_name"))).alias("_names"))
    name = lambda c: F.col("_names").getItem(c)
    # the same keys in the same places for every file, so that one projection types all of them
    rec = F.map_from_arrays(F.array(*[F.lit(c) for c in targets]), F.array(*[F.when(name(c).isNotNull(), F.try_element_at("rec", name(c))) for c in targets]))
    rows = records.join(raw, "file").select(F.struct("file", "rank", F.map_keys("_names").alias("present"), "pos").alias("pos"), rec.alias("rec"))
    plan = resolve_columns(targets, spec)
    typed = conform(rows, spec, plan, rec="rec", pos="pos", key_index={c: i for i, c in enumerate(targets)})
    p = F.col("pos")
    return typed.select("*", p.getField("file").alias("_file"), p.getField("rank").alias("_rank"), p.getField("present").alias("_present")).withColumn(
        "pos", p.getField("pos"))


def file_counts(typed: DataFrame, keys: list[str]) -> DataFrame:
    """file, rows_loaded (candidates), null_key_upserts, bad_rows."""
    f, nk = F.col("flag"), has_null_key(keys)
    return typed.groupBy(F.col("_file").alias("file")).agg(
        F.count_if(f.isin(*UPSERT_FLAGS) | ((f == FLAG_DELETE) & ~nk)).alias("rows_loaded"),
        F.count_if(f.isin(*UPSERT_FLAGS) & nk).alias("null_key_upserts"), F.count_if(F.size("_bad") > 0).alias("bad_rows"))


def folded(typed: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key, as the files leave it when they are loaded in order: ``_has_d`` (a
    file deletes it first), ``_alive`` (a row comes after the last delete) and per column
    ``_c`` (value: the last file's after that delete that has the column; NULL: none has).

    In each file all deletes come before the last add/update row of a key.  A key has at most
    one row per file of its table here, so a frequent key is combined before the shuffle."""
    keys, cols = list(spec.pk), [c for c in dict.fromkeys([*spec.columns, "flag"]) if c not in spec.pk]
    upsert = F.col("flag").isin(*UPSERT_FLAGS)
    rows = typed.where(~has_null_key(keys)).groupBy(*[qcol(k) for k in keys], "_rank").agg(
        F.max_by(F.struct(*[qcol(c) for c in cols], "_present"), F.when(upsert, F.col("pos"))).alias("_w"), F.max(F.col("flag") == FLAG_DELETE).alias("_d"))
    rows = rows.where(F.col("_w").isNotNull() | F.col("_d"))
    last = F.max(F.when(F.col("_d"), F.col("_rank"))).over(Window.partitionBy(*[qcol(k) for k in keys]))
    rows = rows.withColumn("_gone", last).withColumn("_w", F.when(F.col("_gone").isNull() | (F.col("_rank") >= F.col("_gone")), F.col("_w")))
    w = F.col("_w")
    value = lambda c: F.max_by(F.struct(w.getField(c).alias("v")), F.when(F.array_contains(w.getField("_present"), c), F.col("_rank")))
    return rows.groupBy(*[qcol(k) for k in keys]).agg(F.max(F.col("_gone").isNotNull()).alias("_has_d"), F.max(w.isNotNull()).alias("_alive"),
                                                      F.struct(*[value(c).alias(c) for c in cols]).alias("_c"))


def merge_folded(rows: DataFrame, spec: TableSpec, store) -> IngestResult:
    """Publish a table's version after the folded rows.  Columns that no file has keep the
    stored value, unless the key was deleted."""
    keys, rest = list(spec.pk), [c for c in spec.columns if c not in spec.pk]
    spark, target = rows.sparkSession, store.read()
    with scratch(spark, "folded") as at:
        rows.write.parquet(at)
        rows = spark.read.schema(rows.schema).parquet(at)
        held = (target.join(rows.select(*[qcol(k) for k in keys]), keys, "left_semi")
                .select(*[qcol(k) for k in keys], F.struct(*[qcol(c) for c in rest]).alias("_t")))
        full = rows.join(held, keys, "left")
        c, t = F.col("_c"), F.col("_t")
        value = lambda x: (F.when(c.getField(x).isNotNull(), c.getField(x).getField("v")).when(~F.col("_has_d"), t.getField(x)))
        flag = F.when(F.col("_alive"), c.getField("flag").getField("v")).otherwise(F.lit(FLAG_DELETE)).alias("flag")
        won = full.select(*[qcol(k) for k in keys], *[value(x).alias(x) for x in rest if x != "flag"], flag, F.lit(0).alias("pos"), "_has_d")
        with scratch(spark, "winners") as winners:
            won.write.parquet(winners)
            won = spark.read.schema(won.schema).parquet(winners)
            mi = MergeInput(won, spec, spec.columns)
            return publish(won, stored_bytes(spark, winners), store, mi, IngestResult(STATUS_SUCCESS), bulk=True)


def load_folder(spark: SparkSession, folder: str, specs: dict[str, TableSpec], stores: dict | None = None) -> DataFrame:
    """Bulk-load the ``.txt`` files of a folder: each file is a ``{"Table": [...]}`` document for
    the table of its name (any case).  Returns the report: file, table_name, structure, load,
    rows_loaded, notes.

    The folder is one job per step, whatever the number of files: all documents are parsed
    and stored once; names, structure and counts are aggregates by file; records are typed
    once per table.  A file that cannot be loaded is left out as a whole; the others of its
    table are folded in name order into one row per key and merged into the table's store in
    one version.  The driver holds tables and specs, no files."""
    specs = {k.lower(): v for k, v in specs.items()}
    files = feed_folder(spark, folder, catalogue(spark, list(specs)))
    at = scratch_path(spark, "folder-files")
    files.write.parquet(at)
    files = spark.read.parquet(at)
    known = files.where("table_name IS NOT NULL").select("file", "table_name", "rank")
    # the table is stored with the lines, so that a table's turn reads and unpacks its own files only
    lines = read_feed(spark, f"{folder}/*.txt", form="document", strict=True).lines.select("pos", "kind", "rows")
    lines = lines.join(known, F.col("pos.file") == known["file"], "left").select("pos", "kind", "rows", "table_name", "rank")
    at = scratch_path(spark, "folder-lines")
    lines.write.parquet(at)
    lines = spark.read.schema(lines.schema).parquet(at)
    broken = lines.where("kind <> 'rows'").select(F.col("pos.file").alias("file"), F.lit(True).alias("broken")).distinct()
    records = (lines.where("kind = 'rows' AND table_name IS NOT NULL").select(F.col("pos.file").alias("file"), "table_name", "rank", "pos", F.posexplode("rows").alias("elem", "rec"))
               .select("file", "table_name", "rank", F.struct(F.col("pos").alias("line"), "elem").alias("pos"), last_values(F.col("rec")).alias("rec")))
    columns = file_columns(records, specs)
    at = scratch_path(spark, "folder-columns")
    columns.write.parquet(at)
    columns = spark.read.parquet(at)
    typed, counts = {}, None
    for t, s in specs.items():                    # as many jobs and branches as tables
        rows, at = typed_rows(records.where(F.col("table_name") == t), columns.where(F.col("table_name") == t), s), scratch_path(spark, "folder-rows")
        rows.write.parquet(at)
        typed[t] = spark.read.schema(rows.schema).parquet(at)
        own = file_counts(typed[t], list(s.pk))
        counts = own if counts is None else counts.unionByName(own)
    structure = file_structure(known, columns, specs)
    report = files.join(broken, "file", "left").join(structure, "file", "left")
    report = report if counts is None else report.join(counts, "file", "left")
    n = F.col("null_key_upserts")
    error = (F.when(~F.coalesce("has_columns", F.lit(False)), F.concat(F.lit("No valid columns after schema filtering for table="), F.col("table_name")))
             .when(~F.coalesce("has_flag", F.lit(False)), F.concat(F.lit("Required 'flag' column not present for table: "), F.col("table_name")))
             .when(n > 0, F.concat(F.lit("NULL primary key in "), n.cast("string"), F.lit(" add/update rows")))
             .when(F.col("bad_rows") > 0, F.lit("values the declared types cannot store")))
    unknown, parse_error = F.col("table_name").isNull(), F.col("broken").isNotNull()
    report = report.select(
        "file", "file_name", F.coalesce("table_name", F.lit("NOT FOUND")).alias("table_name"),
        F.when(unknown, "SKIP").when(parse_error, "PARSE ERROR").when(F.col("extra_note").isNotNull() | F.col("missing_note").isNotNull(), "MISMATCH").otherwise("MATCH").alias("structure"),
        F.when(unknown | parse_error, "SKIP").when(error.isNull(), "PASS").otherwise("FAIL").alias("load"),
        F.when(~unknown & ~parse_error & error.isNull(), F.coalesce("rows_loaded", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("rows_loaded"),
        F.when(unknown, "No matching table").when(parse_error, F.lit(PARSE_ERROR)).otherwise(
            F.concat_ws(" | ", "extra_note", "missing_note", F.substring(error, 1, LOAD_ERROR_TEXT_LIMIT))).alias("notes"))
    at = scratch_path(spark, "folder-report")
    report.write.parquet(at)
    report = spark.read.parquet(at)
    passed = report.where("load = 'PASS'").select(F.col("file").alias("_file"))
    failed = []
    for t, store in (stores or {}).items():
        res = merge_folded(folded(typed[t.lower()].join(passed, "_file", "left_semi"), specs[t.lower()]), specs[t.lower()], store)
        if res.status != STATUS_SUCCESS:
            failed.append((t.lower(), res.error[:LOAD_ERROR_TEXT_LIMIT]))
    if failed:
        lost = spark.createDataFrame(failed, "table_name string, error string")
        bad = (F.col("load") == "PASS") & F.col("error").isNotNull()
        report = (report.join(F.broadcast(lost), "table_name", "left").withColumn("notes", F.when(bad, F.concat_ws(" | ", F.nullif("notes", F.lit("")), "error")).otherwise(F.col("notes")))
                  .withColumn("rows_loaded", F.when(bad, F.lit(0)).otherwise(F.col("rows_loaded"))).withColumn("load", F.when(bad, "FAIL").otherwise(F.col("load"))))
    return report.select(F.col("file_name").alias("file"), "table_name", "structure", "load", "rows_loaded", "notes")


def load_summary(report: DataFrame) -> DataFrame:
    """Structure warnings (files with extra columns), load pass and fail counts."""
    return report.agg(
        F.count_if(F.col("notes").contains("extra_json=")).alias("structure_warnings"),
        F.count_if(F.col("load") == "PASS").alias("load_pass"),
        F.count_if((F.col("load") == "FAIL") | (F.col("structure") == "PARSE ERROR")).alias("load_fail"),
        F.sum("rows_loaded").cast("bigint").alias("rows_loaded"),
    )


def report_with_totals(report: DataFrame) -> DataFrame:
    """The per-file report followed by a totals row."""
    tot = report.agg(F.lit("TOTAL").alias("file"), F.lit(None).cast("string").alias("table_name"),
                     F.lit(None).cast("string").alias("structure"),
                     F.concat(F.count_if(F.col("load") == "PASS").cast("string"), F.lit("/"),
                              F.count_if(F.col("load").isin("PASS", "FAIL")).cast("string")).alias("load"),
                     F.sum("rows_loaded").cast("bigint").alias("rows_loaded"),
                     F.lit(None).cast("string").alias("notes"))
    return report.unionByName(tot)
