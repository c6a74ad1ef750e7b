"""Run registered queries beside their check SQL: python -m tests.check [sf] [name ...]"""
from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ROOT = "/root/testdata"


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{sf}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, bool) or v is None:
        return str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, con, sf, name, query, text):
    """Empty string when equal, else what differs."""
    df = query(spark, f"{ROOT}/{sf}")
    got, gc = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if text is None:
        return "" if got else "no rows"
    res = con.execute(text)
    want, wc = rows_of([d[0] for d in res.description], res.fetchall())
    if gc != wc:
        return f"columns {gc} != {wc}"
    if got == want:
        types = {f.name: f.dataType.simpleString() for f in df.schema}
        sqlt = {d[0]: str(d[1]) for d in res.description}
        pairs = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}
        odd = {c: (types[c], sqlt[c]) for c in types if pairs.get(types[c], types[c]) != sqlt[c]}
        return f"types {odd}" if odd else ""
    gs, ws = set(got), set(want)
    return f"rows {len(got)} vs {len(want)}; spark-only {sorted(gs - ws)[:3]}; sql-only {sorted(ws - gs)[:3]}"[:1500]


def main() -> None:
    from lanestride.plans.registry import CHECK_SQL, QUERIES
    from lanestride.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in names:
        t = time.time()
        try:
            diff = compare(spark, con, sf, name, QUERIES[name], CHECK_SQL.get(name))
        except Exception as exc:  # noqa: BLE001
            diff = f"{type(exc).__name__}: {str(exc)[:1200]}"
        bad += bool(diff)
        print(f"{'OK ' if not diff else 'BAD'} {name} {time.time() - t:.2f}s {diff}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
