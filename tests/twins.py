"""Compare every query with its SQL twin; python -m tests.twins [sf] [names...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir, f"{t}.parquet")
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    """Rows as sorted tuples, columns by name; doubles rounded."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, query, sql: str) -> str:
    """Empty where both give the same columns and rows, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if got == expected:
        return ""
    wrong = [(a, b) for a, b in zip(got, expected, strict=False) if a != b][:2]
    return f"{len(got)} and {len(expected)} rows; {wrong}"


if __name__ == "__main__":
    from forkline.plans import catalog
    from forkline.session import build_session

    sf = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, queries = database(sf), catalog.oracle_sql(), catalog.queries()
    print("without twin:", sorted(set(queries) - set(sql)), "without query:", sorted(set(sql) - set(queries)))
    for name in sys.argv[2:] or queries:
        began = time.time()
        try:
            said = compare(spark, con, sf, queries[name], sql[name])
        except Exception as e:  # noqa: BLE001
            said = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{name}: {said[:900] or 'same'} ({time.time() - began:.1f} s)", flush=True)
