"""File listings as DataFrames (no file content is read)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.names import base_name


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, file_name, length, modified) for the files under ``path``.

    Uses the ``binaryFile`` source and projects only metadata columns, so the
    ``content`` column is pruned and files are listed, not read.  The listing
    itself is distributed by Spark's file index (parallel for many folders)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.load(path)
    return df.select(F.col("path"), base_name("path").alias("file_name"), F.col("length"),
                     F.col("modificationTime").alias("modified"))
