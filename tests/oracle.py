"""Run named queries against their check SQL: ``python -m tests.oracle [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def canonical(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def compare(spark, con, function, sql: str, sf_dir: str) -> tuple[int, list[str]]:
    """Row count and a description of every difference."""
    df = function(spark, sf_dir)
    got = canonical(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = canonical(names, result.fetchall())
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if got != want:
        missing, extra = sorted(set(want) - set(got))[:2], sorted(set(got) - set(want))[:2]
        problems.append(f"rows {len(got)} != {len(want)}; missing {missing}; extra {extra}")
    if not got:
        problems.append("no rows")
    return len(got), problems


def main(argv: list[str]) -> int:
    from meterline.session import build_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, failed = oracle_sql(), 0
    for name, function in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            if name in oracles:
                count, problems = compare(spark, con, function, oracles[name], sf_dir)
            else:
                count, problems = function(spark, sf_dir).count(), []
        except Exception as error:  # report and go on with the next query
            count, problems = 0, [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        kind = "S" if name in oracles else "R"
        print(f"{'FAIL' if problems else 'ok  '} {kind} {name} rows={count} {time.time() - start:.1f}s", *problems, flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
