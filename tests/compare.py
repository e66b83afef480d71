"""Compare every named query with its SQL: ``python tests/compare.py FOLDER [name …]``."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sql_rows(folder: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as con:
        for name in TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        done = con.execute(sql)
        return [c[0] for c in done.description], done.fetchall()


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(r) for r in df.collect()]


def as_sorted(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(ours, theirs) -> str | None:
    (our_columns, our_rows), (their_columns, their_rows) = ours, theirs
    if sorted(our_columns) != sorted(their_columns):
        return f"columns {our_columns} and {their_columns}"
    if len(our_rows) != len(their_rows):
        return f"{len(our_rows)} and {len(their_rows)} rows"
    for a, b in zip(as_sorted(*ours), as_sorted(*theirs)):
        if a != b:
            return str([(x, y) for x, y in zip(a, b) if x != y])
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder, names = sys.argv[1], sys.argv[2:]
    sql = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if names and name not in names or name not in sql:
            continue
        start = time.time()
        try:
            ours = spark_rows(build(spark, folder))
            took = time.time() - start
            found = difference(ours, sql_rows(folder, sql[name]))
            n = len(ours[1])
        except Exception as error:
            took, n, found = time.time() - start, -1, repr(error)[:1500]
        bad += found is not None
        print(f"{'FAIL' if found else 'ok  '} {name:24} {n:8} rows {took:6.2f} s  {(found or '')[:1500]}", flush=True)
    print(f"{bad} differ")
