"""Compare every query with its SQL: `python tests/check_queries.py FOLDER [NAME…]`."""

import datetime
import decimal
import os
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

import __spark_entry__ as spark_entry  # noqa: E402


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float) and value.is_integer():
        return int(value)
    if isinstance(value, list):
        return tuple(plain(item) for item in value)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    found = [tuple(plain(row[n]) for n in order) for row in rows]
    return sorted(columns), sorted(found, key=repr)


def connect(folder):
    connection = duckdb.connect()
    for path in sorted(pathlib.Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def compare(spark, connection, folder, name):
    """None when a query agrees with its SQL, else what differs."""
    frame = spark_entry.queries()[name](spark, folder)
    got = canonical(frame.columns, [tuple(row) for row in frame.collect()])
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        return None if got[1] else "no rows"
    result = connection.execute(sql)
    expected = canonical([item[0] for item in result.description], result.fetchall())
    if not expected[1]:
        return "the SQL gives no rows"
    if got[0] != expected[0]:
        return f"columns {got[0]} instead of {expected[0]}"
    if len(got[1]) != len(expected[1]):
        return f"{len(got[1])} rows instead of {len(expected[1])}"
    for mine, theirs in zip(got[1], expected[1]):
        if mine != theirs:
            return f"{str(mine)[:400]} instead of {str(theirs)[:400]}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Small splits put every kind of row across a border of splits.
        .config("spark.sql.files.maxPartitionBytes", os.environ.get("CHECK_SPLIT_BYTES", "128m"))
        .config("spark.sql.files.openCostInBytes", "1k" if "CHECK_SPLIT_BYTES" in os.environ else "4m")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    tables = connect(sys.argv[1])
    bad = 0
    for query in sys.argv[2:] or spark_entry.queries():
        begin = time.time()
        try:
            problem = compare(session, tables, sys.argv[1], query)
        except Exception as err:  # noqa: BLE001
            problem = f"{type(err).__name__}: {str(err)[:1500]}"
        bad += problem is not None
        print(f"{query:28} {time.time() - begin:6.1f}s {problem or 'ok'}", flush=True)
    sys.exit(bad > 0)
