"""Runs the registered queries and their SQL side by side: python tests/compare.py [folder] [names]."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(r[i] for i in order) for r in rows]
    return [columns[i] for i in order], sorted(picked, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, folder: str, build, sql: str) -> str:
    """Empty text when equal, else what differs."""
    df = build(spark, folder)
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected_names, expected = rows_of(columns, cursor.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    for a, b in zip(got, expected):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            return f"{a} != {b}"
    return "" if got else "no rows"


def main() -> None:
    import __spark_entry__ as entry
    from tillhouse.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(folder), entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if only and name not in only:
            continue
        begin = time.time()
        try:
            result = compare(spark, con, folder, build, oracles[name]) if name in oracles else "no SQL"
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(result)
        print(f"{'ok ' if not result else 'BAD'} {name} {time.time() - begin:.1f}s {result}", flush=True)
    print("bad:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
