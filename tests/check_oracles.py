"""Compare registered queries with their check SQL at one scale factor.

    python tests/check_oracles.py [--sf DIR] [--zone ZONE] [query ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, in a fixed order of rows."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return "null" if v is None else f"{type(v).__name__}:{v}"

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """Why the two results differ, or None."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    expected = canonical(names, relation.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    actual = canonical(spark_df.columns, spark_df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"first difference {a} != {e}"
    return None


def main() -> int:
    from tests.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--zone", default="UTC", help="session time zone")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(**{"spark.sql.session.timeZone": args.zone})
    con = connect(args.sf)
    oracles = entry_points.oracle_sql()
    failed = 0
    for name, run in entry_points.queries().items():
        if args.names and name not in args.names:
            continue
        began = time.monotonic()
        try:
            problem = difference(run(spark, args.sf), con, oracles[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{time.monotonic() - began:6.2f}s {name}: {problem or 'ok'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
