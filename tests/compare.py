"""Compare a Spark result with a DuckDB result, rows in any order."""

import glob
import os
from collections import Counter

import duckdb


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(spark_rows, con, sql):
    """Rows only Spark has and rows only DuckDB has; column names must agree."""
    result = con.execute(sql)
    duck_columns = [d[0] for d in result.description]
    assert sorted(duck_columns) == sorted(spark_rows.columns)
    theirs = as_bag(duck_columns, result.fetchall())
    ours = as_bag(spark_rows.columns, [tuple(r) for r in spark_rows.collect()])
    return ours - theirs, theirs - ours
