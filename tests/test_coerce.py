"""Text -> type rules."""

from pyspark.sql import functions as F, types as T

from tidemark.functions.coerce import coerce
from tidemark.functions.dates import business_date, parse_ddmmyyyy
from tidemark.functions.names import parse_int_list, report_fincode, report_period, report_type
from tidemark.functions.text import clean_text, strip


def _one(spark, values, dtype, **kw):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    v, bad = coerce("x", dtype, **kw)
    rows = df.select(v.alias("v"), (bad if bad is not None else F.lit(False)).alias("bad")).collect()
    return [(r["v"], r["bad"]) for r in rows]


def test_integers(spark):
    out = _one(spark, [" 12 ", "12.0", "1e3", "12.5", "n/a", "", "none", "NaN", "+7", "1.0d", "0x10",
                       "9223372036854775807", "inf"], T.LongType())
    assert out == [(12, False), (12, False), (1000, False), (None, True), (None, False), (None, False),
                   (None, False), (None, False), (7, False), (None, False), (None, False),
                   (9223372036854775807, False), (None, True)]
    assert _one(spark, ["12.5", "3000000000"], T.IntegerType(), on_fraction="null") == [(None, False), (None, False)]
    assert _one(spark, ["3000000000"], T.IntegerType())[0] == (None, True)


def test_doubles_and_decimals(spark):
    out = _one(spark, ["1.5", " -2 ", ".5", "5.", "1E-2", "abc", "inf", "-Infinity"], T.DoubleType())
    assert [v for v, _ in out] == [1.5, -2.0, 0.5, 5.0, 0.01, None, float("inf"), float("-inf")]
    dec = _one(spark, ["123456789012345678", "1234567890123456789", "1.4"], T.DecimalType(18, 0))
    assert [str(v) if v is not None else None for v, _ in dec] == ["123456789012345678", None, "1"]
    assert [b for _, b in dec] == [False, True, False]


def test_accepted_timestamp_forms(spark):
    """The forms the target's store takes: ISO, digits only, month first; a bare year is none."""
    good = ["20240131", "01/31/2024", "2024-01-31", "2024-1-31 00:00:00", "20240131 00:00:00", "1/31/2024T00:00:00"]
    rows = _one(spark, [*good, "2024", "2024-01", "31.01.2024", "20241301", "noon"], T.TimestampNTZType())
    assert [b for _, b in rows] == [False] * len(good) + [True] * 5
    assert {str(v) for v, _ in rows[:len(good)]} == {"2024-01-31 00:00:00"}


def test_timestamps_and_lengths(spark):
    ts = _one(spark, ["2024-01-02 03:04:05", "2024-01-02", "31/01/2024", None], T.TimestampNTZType())
    assert [b for _, b in ts] == [False, False, True, False]
    s = _one(spark, ["abc", " abcdef ", "  "], T.StringType(), max_len=5)
    assert s == [("abc", False), ("abcdef", True), (None, False)]


def test_text_cleaning(spark):
    df = spark.createDataFrame([(" a ",), (" ",), ("<NA>",), ("None",), ("x y",)], "x string")
    assert [r[0] for r in df.select(clean_text("x")).collect()] == ["a", None, None, None, "x y"]
    assert [r[0] for r in df.select(strip("x")).collect()] == ["a", "", "<NA>", "None", "x y"]


def test_dates_and_names(spark):
    df = spark.createDataFrame([("2024-03-02 05:59:59", "02032024"), ("2024-03-02 06:00:00", None)],
                               "ts string, d string")
    r = df.select(business_date(F.col("ts").cast("timestamp_ntz")).alias("b"), parse_ddmmyyyy("d").alias("p")).collect()
    assert [str(x["b"]) for x in r] == ["2024-03-01", "2024-03-02"] and str(r[0]["p"]) == "2024-03-02"
    utc = spark.createDataFrame([("2024-03-02 00:15:00",)], "ts string").select(
        business_date(F.col("ts").cast("timestamp"), tz="Asia/Kolkata").alias("b")).first()["b"]
    assert str(utc) == "2024-03-01"          # 05:45 in Kolkata: before the 06:00 cut-off
    n = spark.createDataFrame([("123-a-202503.PDF",), ("x-a-202503.pdf",), ("7-AR-202412.pdf",)], "n string")
    rows = n.select(report_fincode("n"), report_type("n"), report_period("n")).collect()
    assert [tuple(r) for r in rows] == [(123, "A", 202503), (None, None, None), (7, "AR", 202412)]
    lst = spark.createDataFrame([("1, 5,x,,10",)], "s string").select(parse_int_list("s")).first()[0]
    assert lst == [1, 5, 10]
