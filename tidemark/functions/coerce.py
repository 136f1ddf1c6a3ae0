"""Text -> declared type conversion, as column expressions.

Rules (per declared type):

* integers: text that is not a number -> NULL; a number with a fractional part
  (or out of range) is a *violation*, which fails the feed by default
  (``on_fraction='fail'``) or becomes NULL (``on_fraction='null'``);
* floating point: text that is not a number -> NULL, NaN -> NULL;
* decimal: not a number -> NULL; overflow is a violation;
* timestamp / date: the accepted forms are ``yyyy-MM-dd``, ``yyyyMMdd`` and
  ``MM/dd/yyyy``, each with a time and zone after a space or ``T`` if any; other text
  (a bare year too) is a violation (the store would refuse it);
* varchar(n): longer text is a violation.

Spark 4 runs with ANSI mode, so every conversion uses ``try_cast``; a numeric
regex guards against Java-only literal forms such as ``1.0d`` or hex.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from tidemark.functions.text import clean_text

# Decimal number text: optional sign, digits with optional point, optional exponent.
NUMBER_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INFINITY_RE = r"(?i)^[+-]?(inf|infinity)$"
INTEGER_RE = r"^[+-]?\d+$"

_INT_RANGES = {
    "tinyint": (-(2 ** 7), 2 ** 7 - 1),
    "smallint": (-(2 ** 15), 2 ** 15 - 1),
    "int": (-(2 ** 31), 2 ** 31 - 1),
    "bigint": (-(2 ** 63), 2 ** 63 - 1),
}


def to_double(s: Column) -> Column:
    """Cleaned text -> double; non-numbers and NaN -> NULL."""
    ok = s.rlike(NUMBER_RE) | s.rlike(INFINITY_RE)
    d = F.when(ok, s.try_cast("double"))
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def to_integral(s: Column, dtype: T.DataType, d: Column | None = None) -> tuple[Column, Column]:
    """Cleaned text -> integer type. Returns (value, violation).  ``d`` is the
    text parsed as a double, when already computed.  Plain integer text is read
    exactly (``try_cast`` to bigint, so values above 2**53 keep every digit);
    other numbers go through the double and must be whole and in range."""
    name = dtype.simpleString()
    lo, hi = _INT_RANGES[name]
    d = to_double(s) if d is None else d
    exact = s.try_cast("bigint")
    whole_d = F.when((d == F.floor(d)) & (d >= F.lit(float(lo))) & (d < F.lit(float(hi) + 1.0)), d)
    wide = F.coalesce(exact, whole_d.cast("bigint"))
    if name == "bigint":
        value = wide
    else:
        value = F.when(wide.between(lo, hi), wide.cast(name))
    violation = d.isNotNull() & value.isNull()
    return value.cast(dtype), violation


def to_decimal(s: Column, dtype: T.DecimalType) -> tuple[Column, Column]:
    num = F.coalesce(s.rlike(NUMBER_RE), F.lit(False))
    value = F.when(num, s.try_cast(dtype))
    return value, num & value.isNull()


def iso_date_text(s: Column) -> Column:
    """Date text of an accepted form with its date as ``yyyy-MM-dd``; else NULL."""
    rest = r"(?:[T ].*)?$"
    return (F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}" + rest), s)
            .when(s.rlike(r"^\d{8}" + rest), F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3"))
            .when(s.rlike(r"^\d{1,2}/\d{1,2}/\d{4}" + rest), F.regexp_replace(s, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2")))


def to_timestamp_ntz(s: Column) -> tuple[Column, Column]:
    value = iso_date_text(s).try_cast("timestamp_ntz")
    return value, s.isNotNull() & value.isNull()


def to_timestamp(s: Column) -> tuple[Column, Column]:
    value = iso_date_text(s).try_cast("timestamp")
    return value, s.isNotNull() & value.isNull()


def to_date(s: Column) -> tuple[Column, Column]:
    value = iso_date_text(s).try_cast("date")
    return value, s.isNotNull() & value.isNull()


def needs_double(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType, T.FloatType))


def coerce(c, dtype: T.DataType, on_fraction: str = "fail", max_len: int | None = None,
           cleaned: bool = False, d: Column | None = None) -> tuple[Column, Column | None]:
    """Raw value (text or already typed) -> ``dtype``.

    Returns ``(value, violation)``; ``violation`` is a boolean column (or None)
    that is true when a present value cannot be stored in the declared type.
    With ``cleaned`` the input is already cleaned text, and ``d`` may carry it
    parsed as a double: passing column references for both keeps the generated
    code small when many columns are converted at once.
    """
    if on_fraction not in ("fail", "null"):
        raise ValueError("on_fraction must be 'fail' or 'null'")
    col = F.col(c) if isinstance(c, str) else c
    s = col if cleaned else clean_text(col.cast("string"))
    violation = None
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        value, violation = to_integral(s, dtype, d)
        if on_fraction == "null":
            violation = None
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        value = (to_double(s) if d is None else d).cast(dtype)
    elif isinstance(dtype, T.DecimalType):
        value, violation = to_decimal(s, dtype)
    elif isinstance(dtype, T.TimestampNTZType):
        value, violation = to_timestamp_ntz(s)
    elif isinstance(dtype, T.TimestampType):
        value, violation = to_timestamp(s)
    elif isinstance(dtype, T.DateType):
        value, violation = to_date(s)
    elif isinstance(dtype, T.StringType):
        value = s
        if max_len is not None:
            violation = F.coalesce(F.char_length(s) > F.lit(max_len), F.lit(False))
    elif isinstance(dtype, T.BooleanType):
        value = s.try_cast("boolean")
        violation = s.isNotNull() & value.isNull()
    else:
        raise TypeError(f"unsupported declared type {dtype.simpleString()}")
    return value, violation


def violation_of(dtype: T.DataType, s: Column, d: Column | None, v: Column, on_fraction: str = "fail",
                 max_len: int | None = None) -> Column | None:
    """The violation of :func:`coerce` from already computed columns: cleaned
    text ``s``, its double ``d`` and the converted value ``v`` (cheap references,
    so a wide conversion does not repeat each value's expression)."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return None if on_fraction == "null" else (d.isNotNull() & v.isNull())
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return None
    if isinstance(dtype, T.DecimalType):
        return F.coalesce(s.rlike(NUMBER_RE), F.lit(False)) & v.isNull()
    if isinstance(dtype, T.StringType):
        return None if max_len is None else F.coalesce(F.char_length(v) > F.lit(max_len), F.lit(False))
    return s.isNotNull() & v.isNull()          # timestamps, dates, booleans


def is_fractional(c) -> Column:
    """Text that is a number but not a whole one (would fail an integer column)."""
    s = clean_text(F.col(c) if isinstance(c, str) else c)
    d = to_double(s)
    return d.isNotNull() & ~((d == F.floor(d)) & (F.abs(d) != F.lit(float("inf"))))
