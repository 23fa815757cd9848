"""Run registered queries beside their DuckDB twins: python tests/compare.py [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(r[i]) for i in order) for r in rows))


def difference(spark_df, con, sql: str) -> str | None:
    """None when columns and rows agree exactly, else a short description."""
    got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = canonical(columns, result.fetchall())
    if sorted(spark_df.columns) != sorted(columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not got:
        return "no rows on either side"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    import __spark_entry__ as E
    from wattspan.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, sql = connect(sf_dir), E.oracle_sql()
    for name, query in E.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sql:
                verdict = difference(df, con, sql[name]) or "ok"
            else:
                verdict = f"rows only: {len(df.collect())}"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {str(error)[:600]}"
        print(f"{name:26s} {time.time() - started:6.1f}s  {verdict[:700]}", flush=True)


if __name__ == "__main__":
    main()
