"""Run registered queries and their SQL side by side: python -m tests.compare [sf] [name prefix ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("null",)
    if isinstance(v, float):
        return ("f", repr(v))
    return (type(v).__name__, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, connection, query, sql, sf_dir) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    df = query(spark, sf_dir)
    got, got_columns = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(sql)
    want, want_columns = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns differ: {sorted(set(got_columns) ^ set(want_columns))}"
    if got == want:
        return None
    if len(got) != len(want):
        return f"{len(got)} rows, SQL gives {len(want)}"
    off = [(g, w) for g, w in zip(got, want) if g != w]
    cells = [(c, a, b) for c, a, b in zip(got_columns, *off[0]) if a != b]
    return f"{len(off)} of {len(got)} rows differ, first {cells[:3]}"


def main() -> None:
    import __spark_entry__ as entry
    from floorlens.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:])
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        began = time.time()
        try:
            if name in sqls:
                problem = compare(spark, connection, query, sqls[name], sf_dir)
            else:
                problem = None if query(spark, sf_dir).count() >= 0 else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql " if name in sqls else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - began:6.2f}s {name} {problem or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
