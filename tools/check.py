"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python tools/check.py [sf_dir] [name-part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from microbook.queries import ORACLES, QUERIES  # noqa: E402
from microbook.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    """A value as sorted text; doubles by their exact repr, whole numbers alike in both engines."""
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if hasattr(value, "as_integer_ratio") and not isinstance(value, (int, bool)):
        return repr(float(value))
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, sf: str, name: str) -> tuple[bool, str]:
    started = time.time()
    df = QUERIES[name](spark, sf)
    ours = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if name not in ORACLES:
        return True, f"{len(ours)} rows, no SQL, {took:.1f}s"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows_of(df.columns, ours), rows_of(names, theirs)
    if a == b:
        return True, f"{len(a)} rows, {took:.1f}s"
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return False, f"{len(a)} vs {len(b)} rows {sorted(names)}\n   spark {only_a}\n   sql   {only_b}"


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = local_session()
    bad = []
    for name in QUERIES:
        if parts and not any(p in name for p in parts):
            continue
        try:
            ok, note = compare(spark, sf, name)
        except Exception as error:  # report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
