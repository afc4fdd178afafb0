"""Runs registered queries against their SQL counterparts and reports differences.

``python tests/compare.py [folder] [query ...]``
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = []
    for row in df.itertuples(index=False):
        rows.append(tuple("NULL" if pd.isna(v) else str(v) for v in row))
    return sorted(rows)


def difference(spark_df, con, sql: str) -> str | None:
    mine, theirs = spark_df.toPandas(), con.execute(sql).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} against {sorted(theirs.columns)}"
    for column in mine.columns:
        a, b = mine[column].dtype.kind, theirs[column].dtype.kind
        if a != b and not {a, b} <= {"i", "u", "f"}:
            return f"{column} is {mine[column].dtype} against {theirs[column].dtype}"
        if a == "f" or b == "f":
            mine[column], theirs[column] = mine[column].astype(float), theirs[column].astype(float)
    left, right = canonical(mine), canonical(theirs)
    if left == right:
        return None
    a, b = set(left), set(right)
    return f"{len(left)} against {len(right)} rows; only ours {sorted(a - b)[:2]}; only theirs {sorted(b - a)[:2]}"


def main() -> int:
    from tests.conftest import make_session

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = difference(queries[name](spark, folder), con, oracle[name])
        except Exception as exc:
            problem = f"{type(exc).__name__}: {exc}"[:600]
        failed += problem is not None
        print(name, f"{time.time() - start:.1f}s", problem or "equal", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
