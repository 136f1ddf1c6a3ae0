"""Date expressions: business date, ddMMyyyy forms, retention cut-offs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.spec import BUSINESS_DAY_CUTOFF_HOUR


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def business_date(ts, tz: str | None = None, cutoff_hour: int = BUSINESS_DAY_CUTOFF_HOUR, given=None) -> Column:
    """Business date of a run started at ``ts``.

    Before ``cutoff_hour`` local time the run belongs to the previous day.  ``ts``
    is an instant (TIMESTAMP) converted to ``tz`` when ``tz`` is given, or a local
    wall-clock time (TIMESTAMP_NTZ) when ``tz`` is None.  A ``given`` date column
    (an explicit date for the run) wins when not NULL.
    """
    t = _col(ts)
    if tz is not None:
        t = F.from_utc_timestamp(t, tz)
    d = F.when(F.hour(t) < cutoff_hour, F.date_sub(F.to_date(t), 1)).otherwise(F.to_date(t))
    if given is not None:
        d = F.coalesce(_col(given), d)
    return d


def parse_ddmmyyyy(c) -> Column:
    """'31012024' -> DATE 2024-01-31 (NULL when not a date)."""
    return F.try_to_date(_col(c), "ddMMyyyy")


def format_ddmmyyyy(c) -> Column:
    return F.date_format(_col(c), "ddMMyyyy")


def older_than(ts, now, days: int) -> Column:
    """``ts < now - days``: rows past retention."""
    return _col(ts) < (_col(now) - F.make_interval(days=F.lit(days)))


def elapsed_seconds(start, end) -> Column:
    return F.unix_timestamp(_col(end).cast("timestamp")) - F.unix_timestamp(_col(start).cast("timestamp"))
