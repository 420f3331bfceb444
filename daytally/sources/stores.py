"""Keyed-store and SQL-database sinks: options and statements, as in ``topics``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daytally.operators.latest import VERSION
from daytally.operators.reports import Report


def keyed_store_options(keyspace: str, table: str) -> dict[str, str]:
    return {"keyspace": keyspace, "table": table}


def write_keyed_store(rows: DataFrame, keyspace: str, table: str) -> None:
    """Append; the store itself replaces rows of an equal key."""
    (
        rows.write.format("org.apache.spark.sql.cassandra")
        .options(**keyed_store_options(keyspace, table))
        .mode("append")
        .save()
    )


def jdbc_options(url: str, table: str, user: str, password: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password}


def stage_report(rows: DataFrame, url: str, staging: str, user: str, password: str) -> None:
    """Write a report's newest rows to a staging table, from which ``merge_sql`` upserts."""
    rows.write.format("jdbc").options(**jdbc_options(url, staging, user, password)).mode("overwrite").save()


def merge_sql(report: Report, target: str, staging: str) -> str:
    """One set-based upsert for a whole micro-batch. Rows carry their version, and a row
    that comes late does not replace a newer one."""
    columns = ", ".join([*report.columns, VERSION])
    changed = ", ".join(f"{m} = EXCLUDED.{m}" for m in [*report.measure_names, VERSION])
    return (
        f"INSERT INTO {target} ({columns}) SELECT {columns} FROM {staging} "
        f"ON CONFLICT ({', '.join(report.key_names)}) DO UPDATE SET {changed} "
        f"WHERE {target}.{VERSION} < EXCLUDED.{VERSION}"
    )


_SQL_TYPES = {
    T.DateType(): "DATE",
    T.StringType(): "TEXT",
    T.IntegerType(): "INTEGER",
    T.LongType(): "BIGINT",
    T.DoubleType(): "DOUBLE PRECISION",
    T.BinaryType(): "BYTEA",
}


def create_sql(report: Report, table: str) -> str:
    """The table that ``merge_sql`` upserts into, keyed as the report. Keys are never null:
    messages that lack a field are in quarantine."""
    columns = ", ".join(f"{f.name} {_SQL_TYPES[f.dataType]}" for f in report.schema)
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {VERSION} BIGINT, PRIMARY KEY ({', '.join(report.key_names)}))"


def statement_runner(spark: SparkSession, url: str, user: str, password: str) -> Callable[[str], None]:
    """A function that executes one statement in the database, by the driver's JDBC package."""
    drivers = spark.sparkContext._jvm.java.sql.DriverManager

    def run(sql: str) -> None:
        connection = drivers.getConnection(url, user, password)
        try:
            connection.createStatement().execute(sql)
        finally:
            connection.close()

    return run


def upsert_sink(report: Report, url: str, table: str, user: str, password: str, run: Callable[[str], None]) -> Callable[[DataFrame], None]:
    """A sink for ``start_consumer``: stage a micro-batch's rows, then ``run`` the merge.

    ``run`` executes a statement in the database; Spark has no call for that.
    """
    staging = f"{table}_staging"

    def write(rows: DataFrame) -> None:
        stage_report(rows, url, staging, user, password)
        run(merge_sql(report, table, staging))

    return write
