"""Run registered queries against their SQL twins: ``python tests/oracle_check.py SF [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "float": "FLOAT",
}


def normal(value):
    if isinstance(value, float):
        return None if value != value else (0.0 if value == 0 else value)
    return value


def compare(frame, connection, sql) -> str:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    rows = cursor.fetchall()
    mine = frame.columns
    if sorted(mine) != sorted(names):
        return f"columns {sorted(mine)} against {sorted(names)}"
    wrong = {n: (t, kinds[n]) for n, t in frame.dtypes if TYPES.get(t, t) != kinds[n]}
    order = sorted(names)
    theirs = Counter(tuple(normal(r[names.index(c)]) for c in order) for r in rows)
    ours = Counter(tuple(normal(r[c]) for c in order) for r in frame.collect())
    if ours != theirs:
        a, b = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
        return f"values differ: {sum((ours - theirs).values())} of {sum(ours.values())}/{sum(theirs.values())}\n   spark {a}\n   sql   {b}"
    return f"types {wrong}" if wrong else f"ok {sum(ours.values())}"


def main(sf: str, only: list[str]) -> int:
    import __spark_entry__ as driver

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    folder = f"/root/testdata/sf{sf}"
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    queries, twins = driver.queries(), driver.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            frame = query(spark, folder)
            result = compare(frame, connection, twins[name]) if name in twins else f"rows {frame.count()}"
        except Exception as problem:
            result = f"error {type(problem).__name__} {str(problem)[:600]}"
        if not result.startswith(("ok", "rows")):
            bad += 1
        print(f"@ {name}: {result} ({time.time() - start:.1f}s)", flush=True)
    print(f"@ {bad} to look at; without query: {sorted(set(twins) - set(queries))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) and 1)
