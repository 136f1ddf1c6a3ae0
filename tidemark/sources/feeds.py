"""JSON feed readers: line-per-record, one-line envelopes, whole documents.

Every reader yields *records*: ``(pos, rec)`` where ``rec`` is a
``map<string,string>`` (JSON scalars as text, nested values as JSON text) and
``pos`` is the arrival order (a struct that sorts like the input: file, block,
row within the block, element within the line).  Parsing is ``from_json`` on the
executors; nothing is collected.

Line rules: trim; skip blank and bracket-only lines; a line that is a whole
``{"Table":[...]}`` envelope yields its elements; otherwise the line is parsed as
it is and, failing that, with the wrapper text (leading ``{"Table":[`` and
``,``, trailing ``,`` and ``]}``) removed.  A line must hold exactly one JSON
value.  An object whose message/error text says "no data found", "no record
found" or "error" is a status envelope, not data.  Anything else is malformed:
kept aside with its text and counted.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.text import is_status_message, strip
from tidemark.sources.splits import SPLIT_OVER, WHOLE, any_above, fragments, split_documents
from tidemark.spec import BRACKET_ONLY_LINES, ENVELOPE_PREFIX, ENVELOPE_SUFFIX

RECORD = "map<string,string>"
RECORDS = "array<map<string,string>>"
ENVELOPE = "struct<Table: array<map<string,string>>>"
_JSON_OPTS = {"allowSingleQuotes": "false", "allowUnquotedFieldNames": "false",
              "allowNumericLeadingZeros": "false", "allowBackslashEscapingAnyCharacter": "false"}


@dataclass
class ParsedFeed:
    """Output of a reader.  ``lines`` holds one row per input line with its kind."""

    lines: DataFrame       # pos, value, kind, rows (+ opens: the first row of its document)
    records: DataFrame     # pos, rec
    malformed: DataFrame   # pos, value

    def stats(self) -> DataFrame:
        """One row: lines, skipped, malformed, status_messages, records."""
        return self.lines.agg(*_line_counts(self.lines))

    def observed(self, observation) -> DataFrame:
        """``records``, with the counts of :meth:`stats` observed in the job that
        reads them, so a feed's text is parsed once for both."""
        return _records(self.lines.observe(observation, *_line_counts(self.lines)))


def _line_counts(lines: DataFrame) -> list[Column]:
    k = F.col("kind")
    return [
        (F.count_if(F.col("opens")) if "opens" in lines.columns else F.count(F.lit(1))).alias("lines"),
        F.count_if(k == "skip").alias("skipped"),
        F.count_if(k == "malformed").alias("malformed"),
        F.count_if(k == "message").alias("status_messages"),
        F.coalesce(F.sum(F.when(k == "rows", F.size("rows"))), F.lit(0)).cast("bigint").alias("records"),
    ]


def _wrapped(x: Column) -> Column:
    """``[x]`` parsed as an array of JSON texts: one element iff ``x`` is exactly one
    JSON value (a second value or trailing text makes it longer or NULL)."""
    return F.from_json(F.concat(F.lit("["), x, F.lit("]")), "array<string>", _JSON_OPTS)


def _drop_trailing_comma(t: Column) -> Column:
    return F.when(t.endswith(","), t.substr(F.lit(1), F.length(t) - 1)).otherwise(t)


def _strip_wrappers(t: Column) -> Column:
    s = strip(F.regexp_replace(t, r",$", ""))
    s = F.regexp_replace(s, "^" + re.escape(ENVELOPE_PREFIX), "")
    s = F.regexp_replace(s, re.escape(ENVELOPE_SUFFIX) + "$", "")
    s = F.regexp_replace(s, r"^,", "")
    return strip(s)


def _mentions_status(text: Column) -> Column:
    """Cheap pre-check on the raw text: a status envelope carries one of the keys
    Message, message, Error, error, so the text holds "essage" or "rror"."""
    return (F.instr(text, "essage") > 0) | (F.instr(text, "rror") > 0)


def _rows_of(cand: Column, ok: Column) -> Column:
    """Records of one JSON value: object -> [object], array of objects -> the array."""
    obj = F.from_json(F.when(ok & cand.startswith("{"), cand), RECORD, _JSON_OPTS)
    arr = F.from_json(F.when(ok & cand.startswith("["), cand), RECORDS, _JSON_OPTS)
    return F.coalesce(F.when(obj.isNotNull(), F.array(obj)),
                      F.when(F.forall(arr, lambda r: r.isNotNull()), arr))


def classify_lines(lines: DataFrame, value: str = "value", pos: str = "pos") -> DataFrame:
    """Per line: ``kind`` in (skip, rows, message, malformed) and the parsed ``rows``.

    Object lines, the common case, cost one parse: ``[line]`` read as an array
    of records is non-NULL with one element exactly when the line is one JSON
    object.  Other candidates (wrapper text removed, bare arrays, envelopes) are
    parsed only for the lines that need them.  Staged projections keep every
    parse at once per line (Spark does not collapse a projection whose
    non-trivial expressions a later one uses several times)."""
    t = strip(F.col(value))
    s1 = lines.select(F.col(pos).alias("pos"), F.col(value).alias("value"), t.alias("_t"))
    t = F.col("_t")
    s2 = s1.select("pos", "value", "_t",
                   ((t == "") | t.isin(*BRACKET_ONLY_LINES)).alias("_skip"),
                   (t.startswith(ENVELOPE_PREFIX) & t.endswith(ENVELOPE_SUFFIX)).alias("_is_env"),
                   _drop_trailing_comma(t).alias("_a"))
    a = F.col("_a")
    s3 = s2.select("*", F.from_json(F.when(a.startswith("{"), F.concat(F.lit("["), a, F.lit("]"))),
                                    RECORDS, _JSON_OPTS).alias("_a_obj"))
    a_obj_ok = F.coalesce(F.size("_a_obj") == 1, F.lit(False)) & F.col("_a_obj").getItem(0).isNotNull()
    s4 = s3.select("*", a_obj_ok.alias("_a_obj_ok"))
    # Lines that are not one object as they stand: bare arrays, wrapped lines.
    slow = ~F.col("_a_obj_ok") & ~F.col("_skip")
    s5 = s4.select("*", F.when(slow & a.startswith("["), F.coalesce(F.size(_wrapped(a)), F.lit(0)) == 1)
                   .alias("_a_arr_ok"),
                   F.when(slow, _strip_wrappers(t)).alias("_b"))
    a_ok = F.col("_a_obj_ok") | F.coalesce(F.col("_a_arr_ok"), F.lit(False))
    s6 = s5.select("*", a_ok.alias("_a_ok"))
    b = F.col("_b")
    s7 = s6.select("*", F.when(~F.col("_a_ok"), F.coalesce(F.size(_wrapped(b)), F.lit(0)) == 1).alias("_b_ok"))
    cand = F.when(F.col("_a_ok"), a).otherwise(b)
    env = F.from_json(F.when(F.col("_is_env") & F.col("_a_obj_ok"), F.col("_t")), ENVELOPE, _JSON_OPTS).getField("Table")
    slow_rows = _rows_of(F.when(~F.col("_a_obj_ok"), cand), F.coalesce(F.col("_a_arr_ok"), F.col("_b_ok"), F.lit(False)))
    s8 = s7.select("pos", "value", "_skip", "_a_obj_ok", F.coalesce(b, F.lit("x")).alias("_b"),
                   cand.alias("_cand"), env.alias("_env"),
                   F.when(F.col("_a_obj_ok"), F.col("_a_obj")).otherwise(slow_rows).alias("_line_rows"))
    s9 = s8.select("pos", "value", "_skip", "_b", "_cand", F.col("_env").isNotNull().alias("_from_env"),
                   F.coalesce("_env", "_line_rows").alias("_rows"))
    rows, from_env = F.col("_rows"), F.col("_from_env")
    single_obj = ~from_env & F.col("_cand").startswith("{") & rows.isNotNull()
    kind = (F.when(F.col("_skip") | ((F.col("_b") == "") & ~from_env), "skip")
            .when(rows.isNull(), "malformed")
            .when(single_obj & _mentions_status(F.col("_cand")) & is_status_message(rows.getItem(0)), "message")
            .otherwise("rows"))
    s10 = s9.select("pos", "value", "_rows", kind.alias("kind"))
    return s10.select("pos", "value", "kind", F.when(F.col("kind") == "rows", F.col("_rows")).alias("rows"))


def of_kind(classified: DataFrame, kind: str) -> DataFrame:
    """Lines of one kind: (pos, value).

    Selected through an outer generator and a filter on the generated column: a
    filter on ``kind`` itself would be pushed down through the parsing
    projections by inlining them, multiplying the expression tree; a predicate
    on a generator's output stays above the generator."""
    pick = F.when(F.col("kind") == kind, F.array(F.struct("pos", "value", F.lit(True).alias("_hit"))))
    return classified.select(F.inline_outer(pick)).where(F.col("_hit")).drop("_hit")


def _records(classified: DataFrame) -> DataFrame:
    # The outer generator keeps Spark from inferring a filter on ``rows`` below it
    # (see of_kind); lines without records give one NULL element, dropped above.
    return (classified.select("pos", F.posexplode_outer("rows").alias("elem", "rec"))
            .where(F.col("rec").isNotNull())
            .select(F.struct(F.col("pos").alias("line"), F.col("elem")).alias("pos"), last_values(F.col("rec")).alias("rec")))


def last_values(rec: Column) -> Column:
    """A record whose key comes twice keeps the key's first place and last value."""
    keys, back = F.map_keys(rec), F.reverse(F.map_keys(rec))
    values = F.transform(F.array_distinct(keys), lambda k: F.element_at(F.map_values(rec), (F.size(keys) - F.array_position(back, k) + 1).cast("int")))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.map_from_arrays(F.array_distinct(keys), values)).otherwise(rec)


def parse_lines(lines: DataFrame, value: str = "value", pos: str = "pos") -> ParsedFeed:
    """Lines (a text column + an order column) -> records, malformed lines."""
    c = classify_lines(lines, value, pos)
    return ParsedFeed(c, _records(c), of_kind(c, "malformed"))


def parse_documents(docs: DataFrame, value: str = "value", pos: str = "pos", strict: bool = False) -> ParsedFeed:
    """Whole JSON documents (one per row) -> records.

    A document is an object with a ``Table`` array, or a bare array of objects.
    A status envelope (an object, or a one-element array holding an object, with
    a 'no data' message) yields no rows.  With ``strict`` only the ``Table``
    form is accepted (bulk files); anything else is malformed.
    """
    s1 = docs.select(F.col(pos).alias("pos"), F.col(value).alias("value"), strip(F.col(value)).alias("_t"))
    t = F.col("_t")
    s2 = s1.select("*", (F.coalesce(F.size(_wrapped(t)), F.lit(0)) == 1).alias("_ok"))
    ok = F.col("_ok")
    s3 = s2.select("pos", "value", "_t",
                   F.from_json(F.when(ok & t.startswith("{"), t), ENVELOPE, _JSON_OPTS).alias("_env"),
                   F.from_json(F.when(ok & t.startswith("{"), t), RECORD, _JSON_OPTS).alias("_obj"),
                   F.from_json(F.when(ok & t.startswith("["), t), RECORDS, _JSON_OPTS).alias("_arr"))
    env, obj, arr = F.col("_env"), F.col("_obj"), F.col("_arr")
    obj_msg = obj.isNotNull() & is_status_message(obj)
    arr_msg = (F.size(arr) == 1) & is_status_message(arr.getItem(0))
    table = env.getField("Table")
    rows = table if strict else F.coalesce(table, arr)
    kind = (F.when(t == "", "skip")
            .when(F.lit(not strict) & F.coalesce(obj_msg | arr_msg, F.lit(False)), "message")
            .when(rows.isNull(), "malformed")
            .otherwise("rows"))
    s4 = s3.select("pos", "value", rows.alias("_rows"), kind.alias("kind"))
    c = s4.select("pos", "value", "kind", F.when(F.col("kind") == "rows", F.col("_rows")).alias("rows"))
    return ParsedFeed(c, _records(c), of_kind(c, "malformed"))


def read_lines(spark: SparkSession, path, encoding: str = "UTF-8") -> DataFrame:
    """Text files -> (value, pos) with ``pos`` = (file, block start, row id): file
    order, then line order within a file, stable under re-execution."""
    df = spark.read.option("encoding", encoding).text(path)
    return df.select(
        "value",
        F.struct(F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("pos"),
    )


def read_documents(spark: SparkSession, path, up_to: int | None = None) -> DataFrame:
    """One row per file (of at most ``up_to`` bytes): (value, pos)."""
    df = spark.read.text(path, wholetext=True)
    if up_to is not None:
        df = df.where(F.col("_metadata.file_size") <= up_to)
    return df.select("value", _place(F.col("_metadata.file_path"), F.lit(0), F.lit(0)).alias("pos"))


def _place(file: Column, block: Column, row: Column) -> Column:
    return F.struct(file.alias("file"), block.cast("bigint").alias("block"), row.cast("bigint").alias("row"))


def _split_lines(spark: SparkSession, path, strict: bool, over: int) -> tuple[DataFrame, list[str], list[tuple[str, int]]]:
    """The documents above ``over`` bytes that can be read in splits: their lines, a row
    per record; their files; and (file, bytes) of the others.  The driver sees one row per
    document of that size."""
    docs, records = split_documents(spark, path, over, RECORDS, _JSON_OPTS)
    shown = parse_documents(docs.select(F.col("shown").alias("value"), F.struct("file", "size", "sound", "n", "messages", "first", "base").alias("pos")), strict=strict)
    regular, other, empty = [], [], []
    for r in shown.lines.select("pos.*", "kind", F.size("rows").alias("k")).collect():
        alone = r["base"] == 1 and r["n"] == 1 and r["messages"] == 1 and not strict      # [{"Message": …}]
        if r["sound"] and not alone and r["kind"] == "rows" and r["k"] == min(r["n"], 1):
            first = r["first"] or (0, 0)
            regular.append((r["file"], first[0], first[1]))
            if not r["n"]:
                empty.append((r["file"],))
        else:
            other.append((r["file"], r["size"]))
    kept = spark.createDataFrame(regular, "file string, first_block long, first_at long")
    here = _place(F.col("file"), F.col("block"), F.col("at")).alias("pos")
    opens = (F.col("block") == F.col("first_block")) & (F.col("at") == F.col("first_at"))
    lines = (records.join(F.broadcast(kept), "file")
             .select(here, F.lit(None).cast("string").alias("value"), F.lit("rows").alias("kind"), F.array("rec").alias("rows"), opens.alias("opens")))
    none = spark.createDataFrame(empty, "file string").select(
        _place(F.col("file"), F.lit(0), F.lit(0)).alias("pos"), F.lit(None).cast("string").alias("value"), F.lit("rows").alias("kind"),
        F.array().cast(RECORDS).alias("rows"), F.lit(True).alias("opens"))
    return lines.unionByName(none), [f for f, *_ in regular], other


def _document_feed(spark: SparkSession, path, strict: bool, over: int) -> ParsedFeed:
    opened = lambda feed: feed.lines.withColumn("opens", F.lit(True))
    lines = opened(parse_documents(read_documents(spark, path, over), strict=strict))
    if any_above(spark, path, over):
        large, _, other = _split_lines(spark, path, strict, over)
        lines = lines.unionByName(large)
        whole = [f for f, size in other if size <= WHOLE]
        if whole:
            lines = lines.unionByName(opened(parse_documents(read_documents(spark, whole), strict=strict)))
        too_large = [(f,) for f, size in other if size > WHOLE]
        if too_large:
            lines = lines.unionByName(spark.createDataFrame(too_large, "file string").select(
                _place(F.col("file"), F.lit(0), F.lit(0)).alias("pos"), F.lit(None).cast("string").alias("value"), F.lit("malformed").alias("kind"),
                F.lit(None).cast(RECORDS).alias("rows"), F.lit(True).alias("opens")))
    return ParsedFeed(lines, _records(lines), of_kind(lines, "malformed"))


_DOCUMENT_START = r'^\s*(\{\s*"Table"\s*:\s*)?\['


def _line_feed(spark: SparkSession, path, over: int) -> ParsedFeed:
    """Files of lines.  A large file that begins like a document and is one (an envelope
    on one line, say, or with its records on lines) is read in splits."""
    lines, found = read_lines(spark, path), None
    if any_above(spark, path, over):
        head = fragments(spark, path, over).where("block = 0").select("file", F.substring("value", 1, 200).alias("head"), F.monotonically_increasing_id().alias("row"))
        starts = head.groupBy("file").agg(F.min_by("head", "row").alias("head")).where(F.col("head").rlike(_DOCUMENT_START))
        files = [r["file"] for r in starts.collect()]
        if files:
            found, taken, _ = _split_lines(spark, files, False, over)
            if taken:
                lines = lines.where(~F.col("pos.file").isin(taken))
    feed = parse_lines(lines)
    if found is None:
        return feed
    both = feed.lines.withColumn("opens", F.lit(True)).unionByName(found)
    return ParsedFeed(both, _records(both), of_kind(both, "malformed"))


def read_feed(spark: SparkSession, path, form: str = "auto", strict: bool = False, split_over: int = SPLIT_OVER) -> ParsedFeed:
    """Read a JSON feed.

    ``form``: ``lines`` (line-per-record, envelopes), ``document`` (whole files),
    or ``auto`` (lines; when no line yields a record, the files are read again as
    whole documents).  Documents above ``split_over`` bytes are read by many tasks.
    """
    if form == "document":
        return _document_feed(spark, path, strict, split_over)
    if form not in ("lines", "auto"):
        raise ValueError("form must be 'auto', 'lines' or 'document'")
    feed = _line_feed(spark, path, split_over)
    if form == "auto" and feed.records.isEmpty() and (of_kind(feed.lines, "malformed").isEmpty() is False
                                                      or not of_kind(feed.lines, "message").isEmpty()):
        return _document_feed(spark, path, strict, split_over)
    return feed
