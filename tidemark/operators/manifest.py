"""Incremental catalogue of report files: parse names, find new files, record them.

The listing is a DataFrame of paths (from ``sources.listing.list_files`` or any
other lister); the manifest is a keyed table (fincode, report_type, year_end).
Files already recorded with SUCCESS are skipped by an anti-join on the file
name; Spark broadcasts the name set only when its measured size is under the
broadcast threshold and sort-merge joins it otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import names as N
from tidemark.functions.text import cut
from tidemark.spec import (FILE_ERROR_TEXT_LIMIT, LOCAL_LOCATION_PREFIX, MANIFEST_SPEC, STATUS_FAILED, STATUS_NO_CONTENT,
                           STATUS_SUCCESS, STATUS_WARNINGS)


def parse_listing(listing: DataFrame, name: str = "file_name", path: str | None = "path") -> DataFrame:
    """Report files only (name matches ``{fincode}-{type}-{yyyymm}.pdf``, any case,
    inside a four-digit year folder when a path is given), with parsed fields."""
    df = listing
    if path is not None and path in df.columns:
        df = df.where(N.is_year_folder(N.parent_name(path)))
    df = df.where(N.is_report_file(name))
    return df.select(*df.columns, N.report_fincode(name).alias("fincode"),
                     N.report_type(name).alias("report_type"), N.report_period(name).alias("year_end"))


def loaded_names(manifest: DataFrame) -> DataFrame:
    """File names recorded with SUCCESS."""
    return manifest.where(F.col("status") == STATUS_SUCCESS).select("file_name").distinct()


def catalog(listing: DataFrame, manifest: DataFrame, name: str = "file_name") -> DataFrame:
    """Parsed report files with ``is_new`` (not yet recorded with SUCCESS)."""
    parsed = parse_listing(listing, name)
    done = loaded_names(manifest).withColumnRenamed("file_name", "_done").withColumn("_hit", F.lit(True))
    j = parsed.join(done, parsed[name] == done["_done"], "left")
    return j.select(*parsed.columns, F.col("_hit").isNull().alias("is_new"))


def new_files(listing: DataFrame, manifest: DataFrame, name: str = "file_name") -> DataFrame:
    parsed = parse_listing(listing, name)
    return parsed.join(loaded_names(manifest).withColumnRenamed("file_name", name), name, "left_anti")


def manifest_counts(cat: DataFrame, failed: Column | None = None) -> DataFrame:
    """One row: received, unchanged (already loaded), inserted, rejected, status.
    ``failed`` marks new files whose transfer failed (default: none)."""
    fail = failed if failed is not None else F.lit(False)
    agg = cat.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(~F.col("is_new")).alias("unchanged"),
        F.count_if(F.col("is_new") & ~fail).alias("inserted"),
        F.count_if(F.col("is_new") & fail).alias("rejected"),
    )
    status = (F.when(F.col("received") == 0, STATUS_NO_CONTENT)
              .when(F.col("rejected") > 0, STATUS_WARNINGS).otherwise(STATUS_SUCCESS))
    return agg.select("received", "unchanged", "inserted", "rejected", status.alias("status"))


def records_for(new: DataFrame, location: Column, status: Column | None = None,
                error: Column | None = None, at: Column | None = None) -> DataFrame:
    """Manifest rows for new files (to be merged with ``change_test=False``)."""
    return new.select(
        F.col("fincode").cast("int").alias("fincode"),
        F.col("report_type"),
        F.col("year_end").cast("int").alias("year_end"),
        F.col("file_name"),
        location.alias("azure_blob_url"),
        (status if status is not None else F.lit(STATUS_SUCCESS)).alias("status"),
        (error if error is not None else F.lit(None).cast("string")).alias("error_message"),
        (at if at is not None else F.current_timestamp()).cast("timestamp").alias("downloaded_at"),
    )


def pending(manifest: DataFrame) -> DataFrame:
    """SUCCESS rows whose file still sits at a local fallback location."""
    return manifest.where((F.col("status") == STATUS_SUCCESS) & N.is_local_location("azure_blob_url"))


def update_location(manifest: DataFrame, location: Column, at: Column) -> DataFrame:
    """The manifest after its pending files were moved to ``location``: those rows get
    the new location and the time ``at``, all others stay as they are."""
    moved = (F.col("status") == STATUS_SUCCESS) & N.is_local_location("azure_blob_url")
    return manifest.withColumns({
        "azure_blob_url": F.when(F.coalesce(moved, F.lit(False)), location).otherwise(F.col("azure_blob_url")),
        "downloaded_at": F.when(F.coalesce(moved, F.lit(False)), at.cast("timestamp")).otherwise(F.col("downloaded_at")),
    })


def failed_records(new: DataFrame, error: Column, at: Column | None = None) -> DataFrame:
    """Manifest rows for new files whose transfer failed: no location, the error cut to
    its limit."""
    return records_for(new, F.lit(""), F.lit(STATUS_FAILED), cut(error, FILE_ERROR_TEXT_LIMIT), at)


def local_location(year: Column, file_name: Column) -> Column:
    return F.concat(F.lit(LOCAL_LOCATION_PREFIX + "data/digital_reports/"), year, F.lit("/"), file_name)


SPEC = MANIFEST_SPEC
