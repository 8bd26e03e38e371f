"""Compare registered queries with their SQL on DuckDB.

``python -m tests.compare [sf folder] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, Decimal):
        return str(value.normalize() + 0)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value) if value is not None else None


def rows_of(table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(tuple(plain(v) for v in row) for row in zip(*columns, strict=True))


def type_names(schema) -> dict[str, str]:
    alias = {"large_string": "string", "large_utf8": "string", "utf8": "string"}
    out = {}
    for field in schema:
        kind = alias.get(str(field.type), str(field.type))
        out[field.name] = "timestamp" if kind.startswith("timestamp") else kind
    return out


def difference(frame, con, sql: str) -> tuple[str | None, int]:
    """What differs (None when rows, names and types agree) and the number of rows."""
    mine = frame.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    if type_names(mine.schema) != type_names(theirs.schema):
        a, b = type_names(mine.schema), type_names(theirs.schema)
        return f"schema {sorted(set(a.items()) ^ set(b.items()))}", mine.num_rows
    a, b = rows_of(mine), rows_of(theirs)
    if a != b:
        only = f"{list((a - b).items())[:2]} / {list((b - a).items())[:2]}"
        return f"rows {mine.num_rows} vs {theirs.num_rows}: {only}", mine.num_rows
    return None, mine.num_rows


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from strata.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            frame = build(spark, folder)
            if name in sql:
                verdict, n = difference(frame, con, sql[name])
            else:
                verdict, n = None, frame.toArrow().num_rows
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict, n = f"error {type(error).__name__}: {str(error)[:600]}", -1
        bad += verdict is not None
        kind = "sql" if name in sql else "rows"
        took = time.perf_counter() - start
        mark = "FAIL" if verdict else "ok"
        print(f"{mark} {name} [{kind}] rows={n} {took:.1f}s {verdict or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:]
    sys.exit(main(arguments[0] if arguments else "/root/testdata/sf0.01", arguments[1:]) > 0)
