"""Compare registered queries with their SQL in DuckDB: python tests/compare.py FOLDER [names]."""

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _canonical(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "NULL"
    return repr(value)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    names = [columns[at] for at in order]
    return names, sorted(tuple(_canonical(row[at]) for at in order) for row in rows)


def difference(df, connection, sql):
    """None if the DataFrame and the SQL agree, else what differs."""
    found = normalised(df.columns, [tuple(row) for row in df.collect()])
    answer = connection.execute(sql)
    wanted = normalised([column[0] for column in answer.description], answer.fetchall())
    if found[0] != wanted[0]:
        return f"columns {found[0]} against {wanted[0]}"
    if found[1] == wanted[1]:
        return None
    extra = [row for row in found[1] if row not in wanted[1]][:2]
    missing = [row for row in wanted[1] if row not in found[1]][:2]
    return f"{len(found[1])} rows against {len(wanted[1])}; only ours {extra}; only theirs {missing}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            result = difference(query(spark, folder), connection, entry.oracle_sql()[name])
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:24s} {time.time() - start:6.2f}s {'ok' if result is None else result[:1800]}", flush=True)
