"""Expressions over file names and locations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.spec import LOCAL_LOCATION_PREFIX, REPORT_FILE_PATTERN, YEAR_FOLDER_PATTERN


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path) -> Column:
    """Last path component."""
    return F.regexp_extract(_col(path), r"([^/]*)$", 1)


def parent_name(path) -> Column:
    """Name of the folder holding the file."""
    return F.regexp_extract(_col(path), r"([^/]*)/[^/]*$", 1)


def stem(name) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(_col(name), r"\.[^.]*$", "")


def is_report_file(name) -> Column:
    return _col(name).rlike(REPORT_FILE_PATTERN)


def report_fincode(name) -> Column:
    return F.when(is_report_file(name), F.regexp_extract(_col(name), REPORT_FILE_PATTERN, 1).try_cast("int"))


def report_type(name) -> Column:
    return F.when(is_report_file(name), F.upper(F.regexp_extract(_col(name), REPORT_FILE_PATTERN, 2)))


def report_period(name) -> Column:
    return F.when(is_report_file(name), F.regexp_extract(_col(name), REPORT_FILE_PATTERN, 3).try_cast("int"))


def is_year_folder(name) -> Column:
    return _col(name).rlike(YEAR_FOLDER_PATTERN)


def period_year(period) -> Column:
    """First four digits of a yyyymm period."""
    return F.substring(_col(period).cast("string"), 1, 4)


def is_local_location(loc) -> Column:
    return _col(loc).startswith(LOCAL_LOCATION_PREFIX)


def strip_local_prefix(loc) -> Column:
    return F.regexp_replace(_col(loc), "^" + LOCAL_LOCATION_PREFIX.replace("/", r"\/"), "")


def parse_int_list(c) -> Column:
    """'1, 5,x,10' -> [1, 5, 10]: split on commas, trim, drop empty and non-integers."""
    parts = F.transform(F.split(_col(c), ","), lambda x: F.trim(x))
    ints = F.transform(F.filter(parts, lambda x: x.rlike(r"^[+-]?\d+$")), lambda x: x.try_cast("int"))
    return F.filter(ints, lambda x: x.isNotNull())
