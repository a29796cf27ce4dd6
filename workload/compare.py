"""Run queries beside their SQL counterparts and report differences.

    python -m workload.compare [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from funnelspark.session import build_session
from workload.oracles import ORACLES
from workload.queries import QUERIES
from workload.tables import GIVEN


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def _rows(records, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in records), key=repr)


def differences(spark: SparkSession, folder: str, name: str) -> tuple[str, int]:
    """Empty text when rows and column names agree, else what differs first; and the row count."""
    ours = QUERIES[name](spark, folder)
    got = _rows(ours.collect(), ours.columns)
    con = duckdb.connect()
    for table in GIVEN:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = _rows(cursor.fetchall(), columns)
    if sorted(ours.columns) != sorted(columns):
        return f"columns: {sorted(set(ours.columns) ^ set(columns))}", len(got)
    if len(got) != len(want):
        return f"rows: {len(got)} against {len(want)}", len(got)
    names = sorted(columns)
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        return f"{len(wrong)} rows differ, first: {cells[:6]}", len(got)
    return "", len(got)


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        started = time.time()
        try:
            found, n = differences(spark, folder, name)
        except Exception as e:  # report and go on with the next query
            found, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} rows={n} {time.time() - started:.1f}s {found}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
