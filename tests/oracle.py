"""Run registered queries next to their SQL twins in DuckDB and compare whole results.

    python tests/oracle.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import collections
import datetime
import decimal
import math
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, decimal.Decimal):
        return "decimal " + str(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, dict)):
        raise TypeError("results hold scalars only")
    return value if value is None else f"{type(value).__name__} {value}"


def rows_of(columns: list[str], rows) -> collections.Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    actual = rows_of(df.columns, df.collect())
    if actual == expected:
        return None
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"only here {list(extra)[:2]}; only there {list(missing)[:2]}"
    )


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from edupipe.session import build_session

    folder, *wanted = sys.argv[1:]
    spark = build_session("oracle", "local[8]", **{"spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="oracle-"), "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            sql = oracle_sql().get(name)
            problem = compare(df, con, sql) if sql else (None if df.count() else "no rows")
            kind = "equal" if sql else "rows only"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, kind = f"{type(error).__name__}: {str(error)[:700]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or kind}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
