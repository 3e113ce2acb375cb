"""Run registered queries and compare them with their SQL on DuckDB.

usage: python tools/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s if len(s) == 10 else s.replace(" ", "T")
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v) if not isinstance(v, (list, dict)) else repr(v)


def rows_of(cols: list[str], rows) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def kind(t: str) -> str:
    t = t.lower()
    names = {
        "integer": "int", "varchar": "string", "timestamp_ntz": "timestamp",
        "long": "bigint", "timestamp with time zone": "timestamp",
    }
    return names.get(t, t)


def compare(spark, con, fn, sql, sf_dir) -> tuple[str, float, int]:
    start = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    took = time.time() - start
    if sql is None:
        return "rows", took, len(got)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: kind(str(d[1])) for d in cur.description}
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        diff = set(df.columns) ^ set(names)
        return f"COLUMNS differ: {sorted(diff)}", took, len(got)
    mine = {c: kind(t) for c, t in df.dtypes}
    note = [f"{c}: {mine[c]} vs {types[c]}" for c in names if mine[c] != types[c]]
    if len(got) != len(want):
        return f"ROWS {len(got)} vs {len(want)}", took, len(got)
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        extra, missing = list((a - b).items()), list((b - a).items())
        cols = sorted(names)
        text = f"VALUES differ in {len(extra)} rows"
        x, best = extra[0][0], None
        for y, _ in missing[:20000]:
            same = sum(p == q for p, q in zip(x, y))
            if best is None or same > best[0]:
                best = (same, y)
        if best:
            text += " e.g. " + str(
                [(c, p, q) for c, p, q in zip(cols, x, best[1]) if p != q][:4]
            )
        return text, took, len(got)
    return ("ok" if not note else f"ok but types: {note}"), took, len(got)


def main() -> int:
    from seriesloom.catalog import ORACLES, QUERIES

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark, con = session(), duck(sf_dir)
    bad = 0
    for name in names:
        try:
            verdict, took, n = compare(spark, con, QUERIES[name], ORACLES.get(name), sf_dir)
        except Exception as e:  # report and go on with the next query
            verdict, took, n = f"ERROR {type(e).__name__}: {str(e)[:600]}", 0.0, 0
        good = verdict == "ok" or verdict == "rows"
        bad += not good
        print(f"{'  ' if good else '! '}{name:28s} {took:6.2f}s {n:7d}  {verdict}", flush=True)
    print(f"{len(names) - bad} of {len(names)} fine")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
