"""Compare a registered query with its SQL on DuckDB over the same Parquet files.

Run as a script: python -m tests.oracle [folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, folder, build, sql):
    """None if equal, else a description of the first difference."""
    df = build(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        diff = [(g, w) for g, w in zip(got, want, strict=False) if g != w][:3]
        return f"rows {len(got)} vs {len(want)}; first differences {diff}"
    if not got:
        return "no rows on either side"
    return None


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from strataflow import get_spark

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    cores = os.environ.get("CORES", "8")
    spark = get_spark("oracle", f"local[{cores}]", **{"spark.sql.shuffle.partitions": cores, "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    sqls, bad = oracle_sql(), 0
    for name, build in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, folder, build, sqls[name])
            else:
                problem = None if build(spark, folder).count() >= 0 else "?"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main(sys.argv[1:])
