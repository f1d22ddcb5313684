"""Compare registered queries with their SQL: ``python tests/check_oracles.py [sf_dir] [query ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from cdcflow.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str:
    """Empty when the query and its SQL agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "" if got else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = normal(cursor.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if got != want:
        expected, found = set(want), set(got)
        extra = [r for r in got if r not in expected][:2]
        missing = [r for r in want if r not in found][:2]
        return f"{len(got)} rows against {len(want)}; extra {extra}; missing {missing}"
    return ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session("check", partitions=int(os.environ.get("CHECK_PARTITIONS", "8")))
    spark.sparkContext.setLogLevel("OFF")
    spark.conf.set("spark.sql.session.timeZone", os.environ.get("CHECK_ZONE", "UTC"))
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem[:1500]}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
