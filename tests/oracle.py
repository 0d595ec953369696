"""Compares registered queries with their SQL in DuckDB: ``python tests/oracle.py [sf_dir] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark, con, name: str, sf_dir: str) -> str | None:
    """None if both sides agree in column names and rows, else what differs."""
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if name not in oracle_sql():
        return None if got else "no rows"
    want = con.execute(oracle_sql()[name])
    names = [d[0] for d in want.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = canonical(got, df.columns), canonical(want.fetchall(), names)
    if a == b:
        return None
    first = next(((x, y) for x, y in zip(a, b) if x != y), None)
    return f"rows {len(a)} != {len(b)}; first difference {first}"


def main() -> int:
    from __spark_entry__ import queries
    from panelwright.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in chosen:
        start = time.time()
        try:
            problem = differences(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = str(error)[:600]
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
