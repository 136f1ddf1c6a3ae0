"""Compare a registered Spark query with its DuckDB SQL on the same parquet tables."""

from __future__ import annotations

import math
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return round(float(v), 9)
    except Exception:
        pass
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns differ: spark={scols} duckdb={dcols}")
    if len(srows) != len(drows):
        problems.append(f"row counts differ: spark={len(srows)} duckdb={len(drows)}")
    if not problems:
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a != b:
            diff = [x for x in a if x not in set(b)][:3]
            problems.append(f"values differ, e.g. spark-only rows {diff}")
    return problems, len(srows)


if __name__ == "__main__":
    import os
    import time
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tidemark.session import builder
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = builder("local[8]").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    qs, sq = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        if name not in sq:
            n = fn(spark, sf).count()
            print(f"{name:28s} rows-only   rows={n} {time.time() - t0:.1f}s")
            continue
        try:
            problems, n = compare(spark, con, name, fn, sq[name], sf)
        except Exception as e:  # report and continue
            problems, n = [f"error: {type(e).__name__}: {str(e)[:400]}"], -1
        status = "OK" if not problems else "FAIL"
        bad += bool(problems)
        print(f"{name:28s} {status:4s} rows={n} {time.time() - t0:.1f}s {'; '.join(problems)}")
    print("failures:", bad)
