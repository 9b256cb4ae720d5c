"""Compare queries with their SQL: ``python tests/oracle_check.py sf_dir [query ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def sorted_rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if Spark and SQL agree, else what differs."""
    import __spark_entry__ as contract

    df = contract.queries()[name](spark, sf_dir)
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(contract.oracle_sql()[name])
    want = sorted_rows([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} instead of {want[0]}"
    if got[1] != want[1]:
        extra = sorted(set(got[1]) - set(want[1]))[:2]
        missing = sorted(set(want[1]) - set(got[1]))[:2]
        return f"{len(got[1])} rows, expected {len(want[1])}; extra {extra}; missing {missing}"
    if not got[1]:
        return "no rows at all"
    return None


def main() -> int:
    from packetflow.session import build_session

    import __spark_entry__ as contract

    sf_dir, names = sys.argv[1], sys.argv[2:]
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    spark = build_session("oracle", "local[8]", {**conf, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or contract.queries():
        begin = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report all, then fail
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{name:32} {time.time() - begin:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
