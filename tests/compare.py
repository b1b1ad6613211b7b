"""Run registered queries against their SQL in DuckDB and compare rows, names and values."""

from __future__ import annotations

import decimal
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[str, int]:
    """("ok" or what differs, number of rows)."""
    frame = query(spark, sf_dir)
    rows = [tuple(r) for r in frame.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}", len(rows)
    if len(rows) != len(expected):
        return f"{len(rows)} rows, SQL has {len(expected)}", len(rows)
    got, want = normal(frame.columns, rows), normal(names, expected)
    for a, b in zip(got, want):
        if a != b:
            return f"value {a} != {b}", len(rows)
    return "ok", len(rows)


if __name__ == "__main__":
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as entry

    from salesmart.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("compare", master="local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
                          spark_driver_memory="8g", spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    statements = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        started = time.time()
        if name not in statements:
            print(f"{name:32s} no SQL, {fn(spark, sf).count()} rows  {time.time() - started:.1f}s", flush=True)
            continue
        try:
            verdict, count = compare(spark, con, fn, statements[name], sf)
        except Exception as error:  # report and go on
            verdict, count = f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += verdict != "ok"
        print(f"{name:32s} {verdict}  {count} rows  {time.time() - started:.1f}s", flush=True)
    print("failed:", bad)
    spark.stop()
