"""Validation, key rejection and structure audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.normalize import ColumnPlan, qcol
from tidemark.spec import MESSAGE_NO_FLAG, MESSAGE_NO_KEY, MESSAGE_NO_ROWS, TableSpec


def findings(plan: ColumnPlan, spec: TableSpec, received: int | None = None) -> list[tuple[str, str]]:
    """Feed checks as (level, message).  Errors: PK columns missing.  Warnings: no rows;
    no flag column (every row then counts as an add)."""
    if received == 0:
        return [("warning", MESSAGE_NO_ROWS.format(table=spec.name))]
    out = [] if plan.has_flag else [("warning", MESSAGE_NO_FLAG.format(table=spec.name))]
    missing = pk_missing(spec, plan.resolved)
    return out + ([("error", MESSAGE_NO_KEY.format(table=spec.name, columns=missing))] if missing else [])


def pk_missing(spec: TableSpec, columns: list[str]) -> list[str]:
    return [k for k in spec.pk if k not in columns]


def has_null_key(keys: list[str]):
    cond = F.lit(False)
    for k in keys:
        cond = cond | qcol(k).isNull()
    return cond


def split_rejects(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rows with any NULL key column are rejected.  Text keys
    are already cleaned (blank -> NULL) by ``conform``."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"PK column missing after filtering: {missing}")
    bad = has_null_key(keys)
    return df.where(~bad), df.where(bad)


def rejected_keys(rejected: DataFrame, key: str = "fincode") -> DataFrame:
    """Distinct non-NULL values of ``key`` among rejected rows (empty when the
    feed has no such column)."""
    if key not in rejected.columns:
        return rejected.sparkSession.createDataFrame([], f"{key} string")
    return rejected.select(qcol(key).cast("string").alias(key)).where(qcol(key).isNotNull()).distinct()


def expected_columns(spark: SparkSession, specs: list[TableSpec]) -> DataFrame:
    """(table_name, column_name) for every spec column: a catalogue-sized DataFrame."""
    rows = [(s.name.lower(), c) for s in specs for c in s.columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")


def audit_structure(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """Per table: MATCH or MISMATCH, extra and missing column lists.

    ``observed`` and ``expected`` are (table_name, column_name) DataFrames (names
    already resolved).  ``flag`` is never extra.  Only tables present in
    ``observed`` are reported.
    """
    obs = observed.select("table_name", "column_name").distinct()
    exp = expected.select("table_name", "column_name").distinct()
    extra = obs.where(F.col("column_name") != "flag").join(exp, ["table_name", "column_name"], "left_anti")
    feeds = obs.select("table_name").distinct()
    missing = exp.join(feeds, "table_name", "left_semi").join(obs, ["table_name", "column_name"], "left_anti")
    diffs = (extra.withColumn("kind", F.lit("extra"))
             .unionByName(missing.withColumn("kind", F.lit("missing")))
             .groupBy("table_name")
             .agg(F.array_sort(F.collect_list(F.when(F.col("kind") == "extra", F.col("column_name")))).alias("extra"),
                  F.array_sort(F.collect_list(F.when(F.col("kind") == "missing", F.col("column_name")))).alias("missing")))
    out = feeds.join(diffs, "table_name", "left")
    extra_c = F.coalesce(F.col("extra"), F.array().cast("array<string>"))
    missing_c = F.coalesce(F.col("missing"), F.array().cast("array<string>"))
    return out.select(
        "table_name",
        F.when((F.size(extra_c) == 0) & (F.size(missing_c) == 0), "MATCH").otherwise("MISMATCH").alias("structure"),
        extra_c.alias("extra"),
        missing_c.alias("missing"),
        (F.size(extra_c) > 0).alias("warning"),
    )
