"""Compare queries with their SQL twins in DuckDB: ``python check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

from lamella.plans import ORACLES, QUERIES
from lamella.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2**53 else str(value)
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    frame = QUERIES[name](spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    took = time.time() - start
    if name not in ORACLES:
        return True, f"{len(got)} rows, no oracle, {took:.1f}s"
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if got == want:
        return True, f"{len(got)} rows, {took:.1f}s"
    wanted = set(want)
    extra = [r for r in got if r not in wanted][:3]
    had = set(got)
    missing = [r for r in want if r not in had][:3]
    return False, f"{len(got)} vs {len(want)} rows; only here {extra}; only there {missing}"


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                                "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    failed = 0
    for name in args or QUERIES:
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as error:
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
