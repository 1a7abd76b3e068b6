"""Run registered queries in Spark and their check SQL in DuckDB and compare the rows.

    python tests/oracle.py [sf dir] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as spark_entry  # noqa: E402


def plain(value):
    if value is None:
        return None
    if hasattr(value, "asDict"):
        return tuple(plain(v) for v in value.asDict().values())
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr), [columns[i] for i in order]


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "timestamp": "TIMESTAMP", "date": "DATE"}


def compare(spark, name: str, sf_dir: str) -> list[str]:
    """Differences between the Spark result and the check SQL; empty when they agree."""
    df = spark_entry.queries()[name](spark, sf_dir)
    got, columns = rows_of(df.columns, df.collect())
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        return []
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    cur = con.execute(sql)
    want, want_columns = rows_of([d[0] for d in cur.description], cur.fetchall())
    problems = []
    if columns != want_columns:
        problems.append(f"columns {columns} != {want_columns}")
    types = {d[0]: str(d[1]) for d in con.execute(sql).description}
    declared = dict(con.execute(f"SELECT column_name, column_type FROM (DESCRIBE {sql})").fetchall())
    for field in df.schema.fields:
        simple = field.dataType.simpleString()
        if simple in TYPES and declared.get(field.name) != TYPES[simple]:
            problems.append(f"type of {field.name}: {simple} != {declared.get(field.name, types)}")
    if got != want:
        extra = [r for r in got if r not in set(want)][:3] if len(got) < 50000 else []
        missing = [r for r in want if r not in set(got)][:3] if len(got) < 50000 else []
        problems.append(f"{len(got)} rows != {len(want)} rows; only Spark: {extra}; only SQL: {missing}"[:1500])
    if not got:
        problems.append("no rows")
    return problems


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("webcat.input.partitions", "8").config("spark.ui.enabled", "false").config("spark.python.sql.dataFrameDebugging.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(spark_entry.queries())
    s = session()
    bad = 0
    for n in names:
        start = time.time()
        try:
            found = compare(s, n, sf)
        except Exception as e:  # report and go on with the next query
            found = [f"{type(e).__name__}: {str(e)[:1200]}"]
        bad += bool(found)
        print("ok  " if not found else "FAIL", n, f"{time.time() - start:.1f}s",
              "" if n in spark_entry.oracle_sql() else "(rows only)", *found, flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
