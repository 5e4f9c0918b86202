"""Compare every ``queries()`` key with its ``oracle_sql()`` text in DuckDB.

Usage: ``python tests/oracle_check.py [sf_dir] [key ...]``.  Prints one line
per key and exits non-zero on a mismatch.  The comparison sorts columns by
name and compares rows as a multiset, like the driver's check.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()) if v == v else "nan")
    if isinstance(v, float):
        return ("num", round(v, 9))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", v)
    if isinstance(v, dt.datetime):
        return ("ts", v.isoformat())
    if v is None:
        return ("null",)
    return ("str", str(v))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, sf_dir: str, key: str, query, sql: str | None, con) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    cols = sorted(df.columns, key=str.lower)
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.select(*cols).collect())
    if sql is None:
        return True, f"{sum(got.values())} rows (no oracle)"
    rel = con.sql(sql)
    ocols = rel.columns
    if sorted(c.lower() for c in ocols) != [c.lower() for c in cols]:
        return False, f"columns differ: spark={cols} oracle={sorted(ocols)}"
    idx = {c.lower(): i for i, c in enumerate(ocols)}
    want = Counter(tuple(norm(r[idx[c.lower()]]) for c in cols) for r in rel.fetchall())
    if got == want:
        return True, f"{sum(got.values())} rows match"
    extra = list((got - want).items())[:3]
    missing = list((want - got).items())[:3]
    return False, (f"spark {sum(got.values())} rows, oracle {sum(want.values())}; "
                   f"spark-only {extra}; oracle-only {missing}")


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tapflow.session import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = get_session()
    con = duck(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for key, q in entry.queries().items():
        if only and key not in only:
            continue
        try:
            ok, msg = compare(spark, sf_dir, key, q, sqls.get(key), con)
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"error: {exc!r}"[:2000]
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {key}: {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
