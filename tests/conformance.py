"""Run registered queries beside their SQL and compare by value.

    python tests/conformance.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(x):
    if x is None:
        return "<null>"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float):
        return "<nan>" if math.isnan(x) else repr(x + 0.0)
    if isinstance(x, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in x) + "]"
    return str(x)


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows, expected {len(expected)}"
    got, want = _normal(df.columns, rows), _normal(columns, expected)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(rows)} rows differ ({sorted(columns)}), first: {bad[0][0]} expected {bad[0][1]}"
    if not rows:
        return "no rows"
    return None


def main():
    from bench import session

    import __spark_entry__ as entry

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = session(), oracle(args.sf)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args.names or queries:
        start = time.time()
        try:
            df = queries[name](spark, args.sf)
            problem = compare(df, con, sql[name]) if name in sql else (None if df.count() else "no rows")
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        kind = "sql" if name in sql else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} [{kind}] {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
