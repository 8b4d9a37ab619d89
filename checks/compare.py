"""Run every query on Spark and in DuckDB on the same tables and compare the results.

python -m checks.compare SF_DIR [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

from checks import sql
from checks.queries import QUERIES
from ordermill.session import local_session


def key(value):
    """A value in a form that sorts and compares across both engines, types kept apart."""
    if value is None:
        return ("", "")
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, int):
        return ("int", str(value))
    if isinstance(value, (float, Decimal)):
        return (type(value).__name__, repr(value + 0.0) if isinstance(value, float) else str(value))
    if isinstance(value, (dt.date, dt.datetime)):
        return (type(value).__name__, value.isoformat())
    return (type(value).__name__, str(value))


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(key(row[i]) for i in order) for row in rows)


def main(sf_dir: str, only: list[str]) -> int:
    spark = local_session()
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    texts, bad = sql.all_queries(), []
    for name in only or QUERIES:
        started = time.time()
        frame = QUERIES[name](spark, sf_dir)
        got = rows_of(frame.columns, frame.collect())
        spent = time.time() - started
        if name not in texts:
            print(f"rows  {name}: {len(got[1])} ({spent:.1f}s)")
            continue
        cursor = con.execute(texts[name])
        want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
        if got == want:
            print(f"ok    {name}: {len(got[1])} ({spent:.1f}s)")
            continue
        bad.append(name)
        print(f"DIFF  {name}: {len(got[1])} rows against {len(want[1])}")
        if got[0] != want[0]:
            print("      columns", set(got[0]) ^ set(want[0]))
            continue
        ours, theirs = sorted(set(got[1]) - set(want[1])), sorted(set(want[1]) - set(got[1]))
        for a, b in list(zip(ours, theirs))[:3]:
            print("      ", [(n, x, y) for n, x, y in zip(got[0], a, b) if x != y])
        if not (ours and theirs):
            print("      only one side:", (ours or theirs)[:2])
    print(f"{len(bad)} differ: {bad}")
    return len(bad)


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
