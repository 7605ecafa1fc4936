"""Compare registered queries with their SQL: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, folder):
    """Empty string if both agree, otherwise what differs."""
    df = query(spark, folder)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return "" if got else "no rows"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}; spark {a[:2]} sql {b[:2]}"
    differ = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(differ)} of {len(a)} rows differ, e.g. {str(differ[0])[:600]}" if differ else ""


def main() -> None:
    import __spark_entry__ as entry
    from corpusmap.session import local_session

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, query, sql.get(name), folder)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        mark = "ok " if not problem else "BAD"
        print(f"{mark} {name:24s} {time.time() - start:6.2f}s {'S' if name in sql else 'R'} {problem}", flush=True)
        if problem:
            bad.append(name)
    missing = set(sql) - set(entry.queries())
    print("bad:", bad, "sql without query:", sorted(missing))


if __name__ == "__main__":
    main()
