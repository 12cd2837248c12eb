"""Compares a query with its SQL: python -m tests.oracle SF_DIR NAME..."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf: str):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in Path(sf).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


def plain(x):
    """One form for values of either engine."""
    if hasattr(x, "tzinfo") and x.tzinfo:
        from datetime import timezone

        return x.astimezone(timezone.utc).replace(tzinfo=None)
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, dict):
        return tuple((k, plain(v)) for k, v in x.items())
    if hasattr(x, "asDict"):
        return tuple((k, plain(v)) for k, v in x.asDict().items())
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def compare(spark, sf: str, query, sql: str) -> list[str]:
    """Differences, at most a few; empty if both give the same rows."""
    df = query(spark, sf)
    c = connect(sf)
    c.execute(sql)
    names = [x[0] for x in c.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    order = sorted(names)
    at = [names.index(n) for n in order]
    theirs = Counter(tuple(plain(r[i]) for i in at) for r in c.fetchall())
    ours = Counter(tuple(plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in order]).collect())
    return [f"only in Spark {n} x {r}" for r, n in list((ours - theirs).items())[:5]] + [f"only in SQL {n} x {r}" for r, n in list((theirs - ours).items())[:5]]


if __name__ == "__main__":
    import __spark_entry__ as e
    from tests.conftest import build

    session, queries, sql = build(), e.queries(), e.oracle_sql()
    for name in sys.argv[2:] or queries:
        t = time.time()
        try:
            if name in sql:
                said = compare(session, sys.argv[1], queries[name], sql[name])
                print(name, "SAME" if not said else "DIFFERENT\n  " + "\n  ".join(said), f"{time.time() - t:.1f} s", flush=True)
            else:
                print(name, queries[name](session, sys.argv[1]).count(), "rows, no SQL", f"{time.time() - t:.1f} s", flush=True)
        except Exception as x:
            print(name, "FAILED", str(x)[:1500], flush=True)
