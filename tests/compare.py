"""Runs registered queries in Spark and their SQL in DuckDB and compares the rows.

``python tests/compare.py [names…]`` with ``SF_DIR`` (default sf0.01).
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], Counter(
        tuple(repr(_plain(r[k])) for k in order) for r in rows
    )


def compare(spark, con, sf_dir, name, run, sql) -> str | None:
    """None if equal, else what differs."""
    frame = run(spark, sf_dir)
    left_cols, left = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if not left:
        return "no rows"
    if sql is None:
        return None
    result = con.execute(sql)
    right_cols, right = rows_of([c[0] for c in result.description], result.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} vs {right_cols}"
    if left != right:
        only_left, only_right = left - right, right - left
        return (
            f"{sum(only_left.values())} of {sum(left.values())} rows differ from "
            f"{sum(right.values())}: {sorted(only_left)[:3]} vs {sorted(only_right)[:3]}"
        )
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries

    from loomcast.session import local_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    session = local_session()
    database = duck(folder)
    wanted = sys.argv[1:] or list(queries())
    bad = 0
    for q in wanted:
        started = time.time()
        try:
            problem = compare(session, database, folder, q, queries()[q], oracle_sql().get(q))
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql" if q in oracle_sql() else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {kind:4} {time.time() - started:6.2f}s {q} {problem or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} good")
