"""Run registered queries in Spark and their SQL in DuckDB and compare the results."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value) -> str:
    return f"{type(value).__name__}:{value!r}"


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, con, query, folder: str) -> tuple[str | None, int, float]:
    """None when both results are the same bag of rows under the same column names."""
    began = time.time()
    df = query.run(spark, folder)
    mine_cols, mine_rows = df.columns, [tuple(r) for r in df.collect()]
    took = time.time() - began
    if query.sql is None:
        return None, len(mine_rows), took
    cursor = con.execute(query.sql)
    cols = [d[0] for d in cursor.description]
    rows = cursor.fetchall()
    if sorted(cols) != sorted(mine_cols):
        return f"columns {sorted(mine_cols)} against {sorted(cols)}", len(mine_rows), took
    mine, theirs = bag(mine_cols, mine_rows), bag(cols, rows)
    if mine != theirs:
        only = list((mine - theirs).elements())[:2]
        missing = list((theirs - mine).elements())[:2]
        names = sorted(cols)
        return (
            f"{len(mine_rows)} rows against {len(rows)}, differ in {sum((mine - theirs).values())}\n"
            f"  columns {names}\n  only here {only}\n  only there {missing}"
        ), len(mine_rows), took
    return None, len(mine_rows), took


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from motorledger.queries import QUERIES
    from motorledger.session import local_session

    folder, wanted = argv[0], argv[1:]
    spark, con = local_session(8), connect(folder)
    bad = 0
    for name, query in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            problem, rows, took = differences(spark, con, query, folder)
        except Exception as error:  # noqa: BLE001
            problem, rows, took = f"{type(error).__name__}: {str(error)[:700]}", -1, 0.0
        bad += problem is not None
        flag = "ok" if problem is None else "BAD"
        if problem is None and rows == 0:
            flag = "EMPTY"
        print(f"{flag:5} {name:38} rows={rows:7} {took:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    spark.stop()
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
