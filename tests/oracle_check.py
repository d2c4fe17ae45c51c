"""Compare every registered query with its SQL in an independent engine.

Run as a script: `python tests/oracle_check.py [sf_dir] [name ...]`.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
}


def differences(frame, connection, sql: str) -> list[str]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = [str(d[1]) for d in result.description]
    expected = _sorted_rows(names, result.fetchall())
    actual = _sorted_rows(frame.columns, frame.collect())
    found = []
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} instead of {sorted(names)}"]
    types = dict(frame.dtypes)
    for name, kind in zip(names, kinds):
        if KINDS.get(kind) != types[name]:
            found.append(f"type of {name}: {types[name]} instead of {kind}")
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows instead of {len(expected)}")
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found


def main() -> int:
    import __spark_entry__ as registered
    from rentledger.plans.oracles import SIZED_FOLDER

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    sql = registered.oracle_sql()
    bad = 0
    for name, query in registered.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = query(spark, folder)
            found = differences(frame, connection, sql[name].replace(SIZED_FOLDER, folder)) if name in sql else [] if frame.count() else ["no rows"]
        except Exception as error:  # noqa: BLE001 - every failure is listed
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s {'; '.join(found)}", flush=True)
    print(f"{bad} of {len(registered.queries())} differ; oracles without query: {set(sql) - set(registered.queries())}")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
