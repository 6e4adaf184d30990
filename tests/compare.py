"""Run queries against their SQL and report: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(plain, key=repr)


def differences(spark, con, name: str, sf: str) -> str | None:
    """None if both sides have the same columns and rows, else what differs first."""
    import __spark_entry__ as entry

    QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

    df = QUERIES[name](spark, sf)
    mine = _sorted(df.columns, df.collect())
    cursor = con.execute(ORACLES[name])
    theirs = _sorted([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} / {len(theirs[1])}: {mine[1][:3]} / {theirs[1][:3]}"
    unequal = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    return f"{len(unequal)} of {len(mine[1])} rows, first {unequal[0]}" if unequal else None


def main() -> None:
    import __spark_entry__ as entry

    QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
    from rillflow.session import local_session

    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session("compare"), connect(sf)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                problem = differences(spark, con, name, sf)
            else:
                problem = f"no SQL, {QUERIES[name](spark, sf).count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None and not problem.startswith("no SQL")
        print(f"{name:28s} {time.time() - start:6.1f}s  {problem or 'equal'}", flush=True)
    print(f"{bad} problems")


if __name__ == "__main__":
    main()
