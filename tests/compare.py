"""Runs registered queries beside their SQL twins in DuckDB and compares whole results.

Usage: python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
import traceback
from collections import Counter
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, Decimal):
        return str(value.normalize())
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    result = con.execute(sql)
    want_cols = [d[0] for d in result.description]
    want = result.fetchall()
    got = df.collect()
    problems = []
    if sorted(df.columns) != sorted(want_cols):
        return [f"columns {sorted(df.columns)} != {sorted(want_cols)}"]
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if not want:
        problems.append("oracle is empty")
    a, b = bag(df.columns, [tuple(r) for r in got]), bag(want_cols, want)
    extra, missing = a - b, b - a
    if extra or missing:
        problems.append(
            f"cols {sorted(want_cols)} only spark ({sum(extra.values())}) "
            f"{list(extra)[:3]}; only sql ({sum(missing.values())}) {list(missing)[:3]}"
        )
    return problems


def main(argv: list[str]) -> int:
    from olapkit.workspace import local_session

    from __spark_entry__ import oracle_sql, queries

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = local_session("8")
    con = connect(folder)
    oracles, bad = oracle_sql(), 0
    for name, fn in queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in oracles:
                problems = differences(df, con, oracles[name])
            else:
                n = len(df.collect())
                problems = [] if n else ["no rows"]
        except Exception as e:
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += bool(problems)
        tag = "ok " if name in oracles else "r  "
        print(f"{'BAD' if problems else tag} {name} {time.time() - start:.1f}s", *problems, flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    code = main(sys.argv[1:])
    sys.exit(1 if code else 0)
