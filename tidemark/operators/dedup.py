"""Row selection per key: last arrival wins.

``keep_last`` is an aggregation (``max_by`` over a struct of the row), not a
window: Spark combines it map-side, so a key holding a third of all rows is
reduced to one row per map task before the shuffle and never lands whole in one
task.  The order column must be unique per row (arrival position).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.normalize import qcol


def keep_last(df: DataFrame, keys: list[str], order: str = "pos", where: Column | None = None) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order``.

    ``where`` restricts the candidates (rows failing it never win); keys without
    any candidate are dropped.  Output keeps the input's columns and order.
    """
    if not keys:
        raise ValueError("keep_last needs at least one key column")
    if order not in df.columns:
        raise ValueError(f"keep_last needs an arrival-order column; '{order}' not found")
    rest = [c for c in df.columns if c not in keys]
    ordering = qcol(order) if where is None else F.when(where, qcol(order))
    agg = (df.groupBy(*[qcol(k) for k in keys])
             .agg(F.max_by(F.struct(*[qcol(c) for c in rest]), ordering).alias("_w")))
    if where is not None:
        agg = agg.where(F.col("_w").isNotNull())
    return agg.select(*[qcol(c) if c in keys else F.col("_w").getField(c).alias(c) for c in df.columns])


def keep_last_window(df: DataFrame, keys: list[str], order: str = "pos") -> DataFrame:
    """Same result as :func:`keep_last` with ``row_number``; shuffles every row and
    sorts each key group whole.  Kept for comparison in tests and benchmarks."""
    from pyspark.sql import Window
    w = Window.partitionBy(*[qcol(k) for k in keys]).orderBy(qcol(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def distinct_on_key(df: DataFrame, keys: list[str], order: str = "pos", where: Column | None = None) -> DataFrame:
    """``SELECT DISTINCT ON (keys)`` with an explicit tie-break: the last row by ``order``."""
    return keep_last(df, keys, order, where)
