"""Compare every query with its SQL: `python tests/compare.py [sf_dir] [name part ...]`."""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value: object) -> object:
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp": "TIMESTAMP", "float": "FLOAT"}


def rows_of(names: list[str], rows: list) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf: str, name: str, query, sql: str | None) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} <> {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in cur.description}
    odd = [f"{c}: {t} <> {kinds[c]}" for c, t in df.dtypes if KINDS.get(t, t) != kinds[c]]
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        first = next(((x, y) for x, y in zip(a, b) if x != y), None)
        return f"{len(a)} rows <> {len(b)} rows, first difference {first}"
    if odd:
        return "types " + ", ".join(odd)
    return None if a else "no rows"


def main() -> int:
    from framelake.plans import registry
    from framelake.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                         "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, query in registry.QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf, name, query, registry.SQL.get(name))
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'sql ' if name in registry.SQL else 'rows'} {problem or 'ok'}", flush=True)
    spark.stop()
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
