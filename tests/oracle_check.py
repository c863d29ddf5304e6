"""Compare every query with its DuckDB oracle SQL (row count, column names,
order-insensitive values with floats rounded to 9 significant digits).

    python tests/oracle_check.py [sf_dir] [query ...]
"""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}


def type_mismatches(spark_dtypes, duck_desc):
    """(column, spark type, duckdb type) where the types differ."""
    duck = {c[0]: str(c[1]) for c in duck_desc}
    out = []
    for name, t in spark_dtypes:
        want = SPARK_TO_DUCK.get(t, t.upper())
        if duck.get(name) != want:
            out.append((name, t, duck.get(name)))
    return out


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    sql = e.oracle_sql()
    bad = 0
    for name, fn in e.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        df = fn(spark, sf)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        if name not in sql:
            print(f"{name:26s} rows={len(srows):6d} (no oracle)")
            continue
        try:
            res = con.execute(sql[name])
        except Exception as ex:  # noqa: BLE001
            bad += 1
            print(f"{name:26s} ORACLE ERROR {str(ex)[:300]}")
            continue
        dcols = [c[0] for c in res.description]
        drows = res.fetchall()
        status = "ok"
        types = type_mismatches(df.dtypes, res.description)
        if sorted(scols) != sorted(dcols):
            status = f"COLS spark={sorted(set(scols)-set(dcols))} duck={sorted(set(dcols)-set(scols))}"
        elif len(srows) != len(drows):
            status = f"ROWS spark={len(srows)} duck={len(drows)}"
        else:
            a, b = canon(srows, scols), canon(drows, dcols)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y]
                status = f"VALUES {len(diff)} differ; first: spark={diff[0][0]} duck={diff[0][1]}"
        if status == "ok" and types:
            status = f"TYPES {types}"
        if status != "ok":
            bad += 1
        print(f"{name:26s} rows={len(srows):6d} {time.time()-t:5.2f}s {status}")
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
