"""The jobs of a deployment, one function each; ``python -m daytally`` runs them."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from daytally.functions.envelope import encode_records, good, inspect
from daytally.operators import dimensions, generator
from daytally.operators.reports import ALL_REPORTS
from daytally.schemas import GAZETTEER, SAMPLE_CSV, nullable
from daytally.session import new_folder
from daytally.sources import files, stores, topics
from daytally.streaming import jobs
from daytally.streaming.changelog import changelog_from_topic, compact, create_tables, fold_changelog, newest_rows, publish_ready
from daytally.streaming.raw import fold

DATABASE = "daily_report"


def generate(
    spark: SparkSession,
    sample: str,
    places: str,
    topic: str,
    export: str,
    seed: int,
    max_per_day: int,
    servers: str | None = None,
) -> None:
    """Make a month of records from a sample of sales; send them by key and export them.

    Another seed makes other records with other ids, so a second run adds to the
    totals of the first. The same seed sends to a topic folder once, however often it
    is tried; a broker gets its messages again, as no broker knows of a sending.
    """
    sales = files.read_csv(spark, sample, nullable(SAMPLE_CSV))
    root = new_folder(spark, "dimensions")
    dimensions.indexed_customers(dimensions.customer_dim(sales)).write.parquet(f"{root}/customers")
    dimensions.indexed_products(dimensions.product_dim(sales)).write.parquet(f"{root}/products")
    records = generator.synthesize(
        generator.tries(spark, seed, max_per_day=max_per_day),
        spark.read.parquet(f"{root}/customers"),
        spark.read.parquet(f"{root}/products"),
        files.read_csv(spark, places, GAZETTEER),
        seed,
    )
    # Written once and read twice: both outputs then hold the same rows.
    records.write.parquet(f"{root}/records")
    made = spark.read.parquet(f"{root}/records")
    if servers:
        topics.send_topic(encode_records(made), servers, topic)
    else:
        files.append_topic_files(encode_records(made), topic, f"seed-{seed}")
    files.export_daily(made, export)


def read_messages(spark: SparkSession, topic: str, servers: str | None, fail_on_data_loss: bool = False) -> DataFrame:
    """A topic by name if ``servers`` are given, else a folder of topic files."""
    if servers:
        return topics.read_topic(spark, servers, topic, fail_on_data_loss=fail_on_data_loss)
    return files.read_topic_files(spark, topic)


def stream(
    spark: SparkSession,
    topic: str,
    root: str,
    servers: str | None,
    run: int,
    once: bool,
    changelogs: str | None = None,
    fail_on_data_loss: bool = False,
) -> None:
    """Topic to intake table, good and bad apart; its good records to the changelogs.

    With ``servers`` and ``changelogs`` each report's changes go to the topic of that
    prefix and the report's name as well.
    """
    trigger = jobs.AVAILABLE_NOW if once else {}
    intake = jobs.start_intake(read_messages(spark, topic, servers, fail_on_data_loss), root, **trigger)
    if once:
        jobs.finish([intake])
    streams = [(report, jobs.stream_raw(spark, root, report, run)) for report in ALL_REPORTS.values()]
    send = {name: partial(topics.send_topic, servers=servers, topic=f"{changelogs}{name}") for name in ALL_REPORTS} if servers and changelogs else {}
    reports = jobs.start_reports(streams, root, run, send, **trigger)
    if once:
        jobs.finish(reports)
    else:
        jobs.serve(spark, [intake, *reports])


def database_sinks(spark: SparkSession, url: str, user: str, password: str, prefix: str = "") -> dict[str, Callable[[DataFrame], None]]:
    """For each report a sink that upserts into the database's table of ``prefix`` and its
    name. Tables that are not there are made."""
    run = stores.statement_runner(spark, url, user, password)
    sinks = {}
    for name, report in ALL_REPORTS.items():
        run(stores.create_sql(report, prefix + name))
        sinks[name] = stores.upsert_sink(report, url, prefix + name, user, password, run)
    return sinks


def tables(
    spark: SparkSession,
    root: str,
    run: int,
    once: bool,
    servers: str | None = None,
    changelogs: str = "",
    database: str | None = None,
    user: str = "",
    password_variable: str = "",
    table_prefix: str = "",
    fill: bool = False,
) -> None:
    """Changelogs to typed report tables; what does not fit goes to the rejects.

    With ``servers`` they are read from topics of the prefix ``changelogs``. With the JDBC
    address of a ``database`` every micro-batch is upserted there as well; ``fill`` first
    sends what the tables hold, which a database that is new or was away for long needs.
    Rows go from all tasks to a staging table and from there by one statement; a row that
    is sent again, or late, changes nothing.
    """
    trigger = jobs.AVAILABLE_NOW if once else {}
    sinks = database_sinks(spark, database, user, os.environ.get(password_variable, ""), table_prefix) if database else {}
    queries = []
    for report in ALL_REPORTS.values():
        sink = sinks.get(report.name)
        if fill and sink is not None:
            sink(newest_rows(spark, report, f"{root}/{report.name}"))
        messages = changelog_from_topic(topics.read_topic(spark, servers, changelogs + report.name)) if servers else None
        queries.append(jobs.start_consumer(spark, report, root, run, messages, sink, **trigger))
        queries.append(jobs.start_rejects(spark, report, root, messages, **trigger))
    if once:
        jobs.finish(queries)
        for report in ALL_REPORTS.values():
            publish_ready(spark, report, f"{root}/{report.name}", sinks.get(report.name))
    else:
        jobs.serve(spark, queries)


def final(
    spark: SparkSession, topic: str, root: str, servers: str | None, delay: str, once: bool, fail_on_data_loss: bool = False
) -> None:
    """Day totals that are written once, when a day is over."""
    records = good(inspect(read_messages(spark, topic, servers, fail_on_data_loss)))
    days = jobs.start_final_days(records, root, delay, **(jobs.AVAILABLE_NOW if once else {}))
    jobs.finish([days]) if once else jobs.serve(spark, [days])


def compact_all(spark: SparkSession, root: str) -> None:
    """Fold the intake and every changelog and snapshot every report table, at any time that
    no streaming command folds."""
    fold(spark, root)
    for report in ALL_REPORTS.values():
        fold_changelog(spark, report, f"{root}/{report.name}/changelog")
        compact(spark, report, f"{root}/{report.name}")


def query(spark: SparkSession, root: str, sql: str) -> DataFrame:
    """Ad-hoc SQL over ``daily_report.<report>``, ``<report>_text``, ``<report>_rejects``,
    ``daily_records``, ``quarantine`` and ``final_days``."""
    create_tables(spark, DATABASE, root, list(ALL_REPORTS.values()))
    return spark.sql(sql)
