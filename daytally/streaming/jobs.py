"""Streaming jobs: intake of messages, the three reports, second-stage consumers.

The tables that they keep are in ``raw`` (records) and ``changelog`` (reports).

Each job has its own checkpoint under a root the caller gives. Every ``start_``
function takes the trigger as keyword arguments of ``DataStreamWriter.trigger``; none
means as soon as possible.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from daytally.functions.envelope import RAW, REASON, bad, good, inspect
from daytally.operators.latest import ARRIVED, OFFSET, VERSION, first_version, latest_rows
from daytally.operators.reports import RSD, Report
from daytally.schemas import RECORD_FIELDS
from daytally.session import STATE_SETTINGS, folder_exists, newest_complete, settings
from daytally.streaming.changelog import (
    compact,
    fold_changelog,
    last_part,
    messages_for_topic,
    newest_part,
    publish_ready,
    stream_changelog,
    to_report_types,
    write_changes,
    write_version,
)
from daytally.streaming.publication import begin_run, in_runs, is_behind, mark_caught_up, published_runs
from daytally.streaming.raw import (
    GOOD,
    PART,
    WATERMARK,
    fold,
    mark_read,
    read_quarantine,
    read_raw,
    read_records,
    stream_raw,
    write_part,
)

__all__ = ["GOOD", "read_quarantine", "read_raw", "read_records", "stream_raw"]

# Micro-batches between two folds of the folders they leave.
FOLD_EVERY = 64

AVAILABLE_NOW = {"availableNow": True}


def checkpoint(root: str, name: str) -> str:
    return f"{root}/checkpoints/{name}"


def _start(writer: DataStreamWriter, trigger: dict[str, Any]) -> StreamingQuery:
    return (writer.trigger(**trigger) if trigger else writer).start()


def _append_files(rows: DataFrame, path: str, checkpoint_path: str) -> DataStreamWriter:
    """Append to a file table, each row once.

    The table logs the batches it has. With a new checkpoint batch numbers begin again
    and the table would pass over the first ones, so that is refused.
    """
    spark = rows.sparkSession
    if folder_exists(spark, f"{path}/_spark_metadata") and not folder_exists(spark, f"{checkpoint_path}/offsets"):
        raise ValueError(f"{path} belongs to a stream whose checkpoint is gone: use a new root")
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )


def records_of(messages: DataFrame) -> DataFrame:
    """Good records of a message stream.

    The watermark is on ``ts`` while the reports group by ``ts_date``, so it closes
    nothing: a record of any age still corrects its day.
    """
    return good(inspect(messages)).withWatermark("ts", WATERMARK)


def start_intake(messages: DataFrame, root: str, fold_every: int = FOLD_EVERY, **trigger: Any) -> StreamingQuery:
    """Decode messages once; each micro-batch is a part of the intake (see ``raw``).

    Its folders keep good records, by day, apart from bad messages, by reason; only the
    latter keep their text. Each row keeps its place in the topic. Spark logs a
    micro-batch's time with its offsets, so a batch that runs again stamps the same
    arrival. The parts are folded after every ``fold_every`` batches.
    """
    spark, progress = messages.sparkSession, checkpoint(root, "intake")
    if folder_exists(spark, f"{root}/intake/parts") and not folder_exists(spark, f"{progress}/offsets"):
        raise ValueError(f"{root}/intake belongs to a stream whose checkpoint is gone: use a new root")
    if folder_exists(spark, f"{root}/intake/_spark_metadata"):
        raise ValueError(f"{root}/intake has the layout of an older version: use a new root")
    place = F.col(OFFSET).cast("long") if OFFSET in messages.columns else F.lit(None).cast("long")
    judged = inspect(messages.withColumn(OFFSET, place), carry=[OFFSET])
    is_good = F.col(REASON).isNull()
    rows = judged.select(
        *[c for c in RECORD_FIELDS if c != "ts_date"],
        F.when(~is_good, F.col(RAW)).alias(RAW),
        OFFSET,
        F.current_timestamp().alias(ARRIVED),
        F.coalesce(REASON, F.lit(GOOD)).alias(REASON),
        F.when(is_good, F.col("ts_date")).alias("ts_date"),
    )

    def write(batch_rows: DataFrame, batch: int) -> None:
        write_part(batch_rows, root, batch)
        if batch % fold_every == fold_every - 1:
            fold(batch_rows.sparkSession, root)

    return _start(rows.writeStream.foreachBatch(write).option("checkpointLocation", progress), trigger)


def start_report(
    report: Report,
    records: DataFrame,
    root: str,
    run: int = 0,
    send: Callable[[DataFrame], None] | None = None,
    fold_every: int = FOLD_EVERY,
    **trigger: Any,
) -> StreamingQuery:
    """Keep a report's totals and write each change of them to its changelog.

    ``run`` numbers fresh starts. Each run has a checkpoint of its own and batch numbers
    that begin at 0, so a fresh one must have a higher number than the one before it.
    ``send`` gets each batch as keyed messages too, for a topic. The changelog is folded
    after every ``fold_every`` batches. A later run than the first has read all there is
    before this function returns; until then readers do not see it (see ``publication``).
    """
    return start_reports([(report, records)], root, run, {report.name: send}, fold_every, **trigger)[0]


def start_reports(
    streams: Sequence[tuple[Report, DataFrame]],
    root: str,
    run: int = 0,
    send: Mapping[str, Callable[[DataFrame], None] | None] | None = None,
    fold_every: int = FOLD_EVERY,
    **trigger: Any,
) -> list[StreamingQuery]:
    """Several reports at once, as :func:`start_report`; ``send`` is by the report's name.

    Those of a fresh run first read, side by side, what there is now. That Spark ends a
    query of this trigger when it is through is what tells that they have caught up.
    """
    start = lambda report, records, how: _start_changelog(report, records, root, run, (send or {}).get(report.name), fold_every, how)
    queries: dict[str, StreamingQuery] = {}
    for report, records in streams:
        spark, folder = records.sparkSession, f"{root}/{report.name}"
        if not folder_exists(spark, f"{_progress(root, report, run)}/offsets"):
            _refuse_old_run(f"{folder}/changelog", newest_complete(spark, f"{folder}/changelog", VERSION), run)
        begin_run(spark, folder, run)
        if is_behind(spark, folder, run):
            queries[report.name] = start(report, records, AVAILABLE_NOW)
    finish([*queries.values()])
    for report, records in streams:
        if report.name in queries:
            mark_caught_up(records.sparkSession, f"{root}/{report.name}", run)
        if report.name not in queries or trigger != AVAILABLE_NOW:
            queries[report.name] = start(report, records, trigger)
    return [queries[report.name] for report, _ in streams]


def _progress(root: str, report: Report, run: int) -> str:
    return checkpoint(root, f"report-{report.name}" + (f"-{run}" if run else ""))


def _start_changelog(
    report: Report,
    records: DataFrame,
    root: str,
    run: int,
    send: Callable[[DataFrame], None] | None,
    fold_every: int,
    trigger: dict[str, Any],
) -> StreamingQuery:
    path, of_intake = f"{root}/{report.name}/changelog", PART in records.columns

    def write(rows: DataFrame, batch: int) -> None:
        if of_intake and batch:
            # The batch before is committed now; this one may have to read its files again.
            mark_read(rows.sparkSession, root, report, run, last_part(rows.sparkSession, path, run, batch - 1))
        write_version(rows, path, run, batch, *([PART] if of_intake else []))
        if send is not None:
            send(messages_for_topic(report, rows, run, batch))
        if batch % fold_every == fold_every - 1:
            fold_changelog(rows.sparkSession, report, path)

    wanted = dict.fromkeys([*report.inputs, "ts", *([PART] if of_intake else [])])
    writer = (
        report.aggregate(records.select(*wanted), False, *([F.max(PART).alias(PART)] if of_intake else []))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", _progress(root, report, run))
        .outputMode("update")
    )
    # The watermark closes nothing here, so a batch without data, run only because it
    # moved, would do nothing but cost a commit of all state partitions.
    with settings(records.sparkSession, {**STATE_SETTINGS, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}):
        return _start(writer, trigger)


def _refuse_old_run(path: str, newest: int | None, run: int) -> None:
    """With a new checkpoint, batches of a run already written would be taken for repeats."""
    if newest is not None and newest >= first_version(run):
        raise ValueError(f"{path} has batches of run {run} or later: give a fresh start a higher run")


def start_consumer(
    spark: SparkSession,
    report: Report,
    root: str,
    run: int = 0,
    messages: DataFrame | None = None,
    sink: Callable[[DataFrame], None] | None = None,
    fold_every: int = FOLD_EVERY,
    **trigger: Any,
) -> StreamingQuery:
    """Second stage: read the report's changelog and upsert its typed table.

    Spark's checkpoint keeps the place in the changelog; a new ``run`` has a checkpoint
    of its own and reads all of it again. Rows keep their version, so reading a
    message twice, or late, does not change the keyed table. ``messages`` is a changelog
    from elsewhere, such as a topic; ``sink`` gets the newest row of each key and batch
    as well, with its version, and of a run that readers do not see yet all rows at the
    moment they do. The table is compacted after every ``fold_every`` batches.
    """
    source = stream_changelog(spark, f"{root}/{report.name}/changelog") if messages is None else messages
    typed = to_report_types(report, source)
    path, progress = f"{root}/{report.name}/changes", checkpoint(root, f"table-{report.name}-{run}")
    if not folder_exists(spark, f"{progress}/offsets"):
        _refuse_old_run(path, newest_part(spark, f"{root}/{report.name}"), run)

    publish_ready(spark, report, f"{root}/{report.name}", sink)

    def write(rows: DataFrame, batch: int) -> None:
        session, folder = rows.sparkSession, f"{root}/{report.name}"
        write_changes(report, rows, path, run, batch)
        if sink is not None:
            sink(latest_rows(report, rows.filter(in_runs(published_runs(session, folder))), keep_version=True))
        publish_ready(session, report, folder, sink)
        if batch % fold_every == fold_every - 1:
            compact(rows.sparkSession, report, f"{root}/{report.name}")

    writer = (
        typed.filter(F.col(REASON).isNull())
        .drop(REASON, RAW)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", progress)
        .outputMode("append")
    )
    return _start(writer, trigger)


def start_rejects(
    spark: SparkSession, report: Report, root: str, messages: DataFrame | None = None, **trigger: Any
) -> StreamingQuery:
    """Keep the changelog messages that do not fit the report's types."""
    source = stream_changelog(spark, f"{root}/{report.name}/changelog") if messages is None else messages
    typed = to_report_types(report, source)
    path = f"{root}/{report.name}/rejects"
    return _start(_append_files(bad(typed), path, checkpoint(root, f"rejects-{report.name}")), trigger)


def start_final_days(records: DataFrame, root: str, delay: str = "1 day", **trigger: Any) -> StreamingQuery:
    """Day totals that are written once, when the day is over, with bounded state.

    ``records`` must have no watermark yet. Rows of a day already closed are dropped,
    so the delay must cover the disorder of the feed: a day at least. ``n_records`` counts
    those that were not (see :func:`late_rows`).
    """
    days = (
        records.select("ts", "customer_id", "revenue", "profit")
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 day").alias("day"))
        .agg(
            F.approx_count_distinct("customer_id", RSD).alias("daily_pu"),
            F.sum("revenue").alias("daily_rev"),
            F.sum("profit").alias("daily_profit"),
            F.count(F.lit(1)).alias("n_records"),
        )
        .select(F.to_date("day.start").alias("ts_date"), "daily_pu", "daily_rev", "daily_profit", "n_records")
    )
    with settings(records.sparkSession, STATE_SETTINGS):
        return _start(_append_files(days, f"{root}/final_days", checkpoint(root, "final-days")), trigger)


def late_rows(final_days: DataFrame, records: DataFrame) -> DataFrame:
    """The account of days that are over: (ts_date, sent, counted, late). ``records`` are all
    that were sent; those that came when their day was closed are ``late``. Days before the
    newest finished one are closed; one of which nothing came in time has no row there.

    Spark's own count of what a watermark drops is of groups, after rows of one day and task
    were put together, so it does not tell how many records are missing.
    """
    newest = final_days.agg(F.max("ts_date")).first()[0]
    sent = records.groupBy(F.to_date("ts").alias("ts_date")).agg(F.count(F.lit(1)).alias("sent")).filter(F.col("ts_date") <= F.lit(newest))
    account = sent.join(final_days.select("ts_date", F.col("n_records").alias("counted")), "ts_date", "left")
    return account.fillna(0, ["counted"]).withColumn("late", F.col("sent") - F.col("counted"))


def finish(queries: Sequence[StreamingQuery]) -> None:
    """Wait for bounded runs; the first failure is raised, after the others are stopped."""
    try:
        for query in queries:
            query.awaitTermination()
    except Exception:
        stop(queries)
        raise


def serve(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Run a service until any of its queries ends; a failing one is never overlooked."""
    spark.streams.resetTerminated()
    try:
        while all(query.isActive for query in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for query in queries:
            if not query.isActive and query.exception():
                raise query.exception()
    finally:
        stop(queries)


def stop(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()
