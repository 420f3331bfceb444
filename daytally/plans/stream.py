"""Streaming queries.

Each replays the event table as topic files in several waves: a part of the days
arrives, the jobs run on what is there, the next part arrives. Together the waves are
the whole table. The resulting tables must equal the batch result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.envelope import RAW, REASON
from daytally.operators.latest import latest_records, latest_rows
from daytally.operators.reports import (
    DAILY_ADDRESS,
    DAILY_CATEGORY_PRODUCT,
    DAILY_PU_REV,
    DAILY_USERS,
    REPORTS,
    Report,
    users_over,
    within_bound,
)
from daytally.plans.batch import damaged_messages, kept_without_database, readable, stacked, tidy
from daytally.session import new_folder
from daytally.sources.files import append_topic_files, read_topic_files, topic_messages
from daytally.sources.tables import even_events, event_messages, event_records, to_messages
from daytally.streaming import jobs
from daytally.streaming.changelog import (
    compact,
    create_tables,
    fold_changelog,
    read_changelog,
    read_report,
    to_report_types,
)
from daytally.streaming.raw import fold

NOW = jobs.AVAILABLE_NOW

# Batches in which a second run of publish_run reads its topic, however many files there are.
_BATCHES = 6

# The events cover 30 days from 2024-01-01; whatever lies outside joins the end waves.
_CUTS = ("2024-01-11", "2024-01-21")


def waves() -> list[Column]:
    """Conditions that split the feed by day; every message meets exactly one."""
    day = F.coalesce(F.col("ts_date"), F.lit(""))
    first, second = _CUTS
    return [day < first, (day >= first) & (day < second), day >= second]


Step = Callable[[str, int], None]


def replay(spark: SparkSession, messages: DataFrame, step: Step, parts: list[Column] | None = None) -> None:
    """Let each wave arrive as files, then run ``step`` on the feed so far."""
    feed = new_folder(spark, "feed")
    for number, part in enumerate(parts or waves()):
        append_topic_files(messages.filter(part), feed, f"wave-{number}")
        step(feed, number)


def sent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as messages that are made from its even copy, once for all waves."""
    return event_messages(spark, sf_dir, even_events(spark, sf_dir))


def _report_from_topic(
    spark: SparkSession, sf_dir: str, report: Report, parts: list[Column] | None = None
) -> str:
    root = new_folder(spark, "stream")

    def step(feed: str, _: int) -> None:
        records = jobs.records_of(read_topic_files(spark, feed))
        jobs.finish([jobs.start_report(report, records, root, **NOW)])

    replay(spark, sent_events(spark, sf_dir), step, parts)
    return root


def _latest_of_changelog(spark: SparkSession, root: str, report: Report) -> DataFrame:
    messages = read_changelog(spark, f"{root}/{report.name}/changelog")
    typed = to_report_types(report, messages).filter(F.col(REASON).isNull())
    return latest_rows(report, typed.drop(REASON, RAW))


def _check_users(spark: SparkSession, sf_dir: str, report: Report, rows: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Compare estimated users to the exact number from the event table, or its copy ``events``."""
    records = event_records(spark, sf_dir, events).withColumn("ts_date", F.col("ts_date").cast("date"))
    exact = records.groupBy(*report.key_names).agg(F.count_distinct("customer_id").alias("exact"))
    near = within_bound(F.col("daily_pu"), F.col("exact"))
    others = [c for c in report.columns if c != "daily_pu"]
    checked = rows.join(exact, report.key_names, "left")
    return checked.select(*others, F.coalesce(near, F.lit(False)).alias("pu_in_bound"))


def stream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message arrives twice, the second time, in a later wave, with other amounts;
    each id is kept once, as last sent."""
    root, feed = new_folder(spark, "stream"), new_folder(spark, "feed")
    events = even_events(spark, sf_dir)
    first = event_messages(spark, sf_dir, events)
    changed = {"price": F.col("price") + 1, "quantity": F.col("quantity") + 1, "revenue": F.col("revenue") + 1}
    second = to_messages(event_records(spark, sf_dir, events).withColumns(changed))
    for number, messages in enumerate((first, second)):
        append_topic_files(messages, feed, f"wave-{number}")
        jobs.finish([jobs.start_intake(read_topic_files(spark, feed), root, **NOW)])
    rows = latest_records(jobs.read_raw(spark, root))
    return readable(rows)


def _folded_raw(spark: SparkSession, sf_dir: str) -> str:
    """The feed of :func:`stream_raw` in three parts: the last one, the other amounts of the
    newest days, is not folded."""
    root, feed, events = new_folder(spark, "stream"), new_folder(spark, "feed"), even_events(spark, sf_dir)
    changed = {"price": F.col("price") + 1, "quantity": F.col("quantity") + 1, "revenue": F.col("revenue") + 1}
    second, newest = to_messages(event_records(spark, sf_dir, events).withColumns(changed)), F.col("ts_date") >= _CUTS[1]
    for number, messages in enumerate((event_messages(spark, sf_dir, events), second.filter(~newest), second.filter(newest))):
        append_topic_files(messages, feed, f"wave-{number}")
        jobs.finish([jobs.start_intake(read_topic_files(spark, feed), root, **NOW)])
        if number < 2:
            fold(spark, root)
    return root


def raw_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table from two folds and a part after them."""
    return readable(jobs.read_records(spark, _folded_raw(spark, sf_dir)))


def sql_records_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of it by SQL, which opens that day's segments and the part that is not folded."""
    root, database = _folded_raw(spark, sf_dir), f"daily_report_{uuid.uuid4().hex}"
    create_tables(spark, database, root, [])
    found = spark.sql(f"SELECT * FROM {database}.daily_records WHERE ts_date = DATE'2024-01-15'")
    return readable(kept_without_database(found, database))


def stream_daily_pu_rev(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _report_from_topic(spark, sf_dir, DAILY_PU_REV)
    rows = tidy(_latest_of_changelog(spark, root, DAILY_PU_REV))
    return _check_users(spark, sf_dir, DAILY_PU_REV, rows)


def stream_daily_category_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _report_from_topic(spark, sf_dir, DAILY_CATEGORY_PRODUCT)
    return tidy(_latest_of_changelog(spark, root, DAILY_CATEGORY_PRODUCT))


def stream_daily_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _report_from_topic(spark, sf_dir, DAILY_ADDRESS)
    return _check_users(spark, sf_dir, DAILY_ADDRESS, _latest_of_changelog(spark, root, DAILY_ADDRESS))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest days arrive first: records weeks behind the watermark still count."""
    root = _report_from_topic(spark, sf_dir, DAILY_PU_REV, waves()[::-1])
    return _check_users(spark, sf_dir, DAILY_PU_REV, tidy(_latest_of_changelog(spark, root, DAILY_PU_REV)))


def stream_daily_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days in order, each total written once its day is closed."""
    root = new_folder(spark, "stream")

    def step(feed: str, _: int) -> None:
        records = jobs.good(jobs.inspect(read_topic_files(spark, feed)))
        jobs.finish([jobs.start_final_days(records, root, **NOW)])

    replay(spark, sent_events(spark, sf_dir), step)
    return _check_users(spark, sf_dir, DAILY_PU_REV, tidy(spark.read.parquet(f"{root}/final_days")))


def _run_chain(spark: SparkSession, root: str, feed: str, reports: list[Report]) -> None:
    """Decode once into the intake table, then all reports from it, then their tables."""
    jobs.finish([jobs.start_intake(read_topic_files(spark, feed), root, **NOW)])
    jobs.finish([jobs.start_report(r, jobs.stream_raw(spark, root, r), root, **NOW) for r in reports])
    jobs.finish([jobs.start_consumer(spark, r, root, **NOW) for r in reports])


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jobs stop after each wave and go on from their checkpoints."""
    root = new_folder(spark, "stream")
    step = lambda feed, _: _run_chain(spark, root, feed, [DAILY_PU_REV])
    replay(spark, sent_events(spark, sf_dir), step)
    return _check_users(spark, sf_dir, DAILY_PU_REV, tidy(read_report(spark, DAILY_PU_REV, f"{root}/{DAILY_PU_REV.name}")))


def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One decoded stream feeds three reports, run at the same time: all rows of all three."""
    root, events = new_folder(spark, "stream"), even_events(spark, sf_dir)
    reports = list(REPORTS.values())
    replay(spark, event_messages(spark, sf_dir, events), lambda feed, _: _run_chain(spark, root, feed, reports))
    rows = {}
    for report in reports:
        found = tidy(read_report(spark, report, f"{root}/{report.name}"))
        has_users = "daily_pu" in report.measure_names
        rows[report.name] = _check_users(spark, sf_dir, report, found, events) if has_users else found
    return stacked(rows)


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad messages to quarantine, good ones to the raw table; none lost."""
    root = new_folder(spark, "stream")

    def step(feed: str, _: int) -> None:
        jobs.finish([jobs.start_intake(read_topic_files(spark, feed), root, **NOW)])

    replay(spark, damaged_messages(spark, sf_dir, even_events(spark, sf_dir)), step)
    bad = jobs.read_quarantine(spark, root).groupBy(REASON).agg(F.count(F.lit(1)).alias("n"))
    good = jobs.read_raw(spark, root).agg(F.count(F.lit(1)).alias("n"))
    return bad.unionByName(good.select(F.lit(jobs.GOOD).alias(REASON), "n"))


def changelog_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second stage: the changelog is read as a stream and becomes a keyed table."""
    report = DAILY_PU_REV
    root = _report_from_topic(spark, sf_dir, report)
    jobs.finish([jobs.start_consumer(spark, report, root, **NOW)])
    return _check_users(spark, sf_dir, report, tidy(read_report(spark, report, f"{root}/{report.name}")))


def changelog_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After each wave the changelog is folded and a snapshot made; readers take them and
    what came after."""
    report, root = DAILY_CATEGORY_PRODUCT, new_folder(spark, "stream")

    def step(feed: str, number: int) -> None:
        _run_chain(spark, root, feed, [report])
        if number < len(waves()) - 1:
            fold_changelog(spark, report, f"{root}/{report.name}/changelog")
            compact(spark, report, f"{root}/{report.name}")

    replay(spark, sent_events(spark, sf_dir), step)
    return tidy(read_report(spark, report, f"{root}/{report.name}"))


def replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two waves are consumed by one run, then from the start by a higher one, and a
    snapshot is made; the third wave comes by the lower run, which goes on."""
    report, root = DAILY_PU_REV, new_folder(spark, "stream")

    def step(feed: str, number: int) -> None:
        records = jobs.records_of(read_topic_files(spark, feed))
        jobs.finish([jobs.start_report(report, records, root, **NOW)])
        jobs.finish([jobs.start_consumer(spark, report, root, run=0, **NOW)])
        if number == 1:
            jobs.finish([jobs.start_consumer(spark, report, root, run=1, **NOW)])
            compact(spark, report, f"{root}/{report.name}")

    replay(spark, sent_events(spark, sf_dir), step)
    return _check_users(spark, sf_dir, report, tidy(read_report(spark, report, f"{root}/{report.name}")))


def publish_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two waves go through a first run. A second one begins when the last wave is there, in
    batches of a file each, or of more where there are many; between them its table is read: ``lost`` counts the days that
    were then seen with less revenue than before."""
    report, root, feed = DAILY_PU_REV, new_folder(spark, "stream"), new_folder(spark, "feed")
    path, messages, lost = f"{root}/{report.name}", sent_events(spark, sf_dir), []
    for number, part in enumerate(waves()):
        append_topic_files(messages.filter(part), feed, f"wave-{number}")
        if number < len(waves()) - 1:
            jobs.finish([jobs.start_report(report, jobs.records_of(read_topic_files(spark, feed)), root, **NOW)])
            jobs.finish([jobs.start_consumer(spark, report, root, **NOW)])
    before = written_rows(read_report(spark, report, path), "before").select("ts_date", F.col("daily_rev").alias("before"))

    def look(_: DataFrame | None) -> None:
        jobs.finish([jobs.start_consumer(spark, report, root, **NOW)])
        both = before.join(read_report(spark, report, path), "ts_date", "left")
        lost.append(both.filter(F.coalesce("daily_rev", F.lit(0.0)) < F.col("before") - 0.005).count())

    files = len(topic_messages(spark, feed).inputFiles())
    again = jobs.records_of(read_topic_files(spark, feed, maxFilesPerTrigger=str(max(1, -(-files // _BATCHES)))))
    jobs.finish([jobs.start_report(report, again, root, run=1, send=look, **NOW)])
    look(None)
    rows = _check_users(spark, sf_dir, report, tidy(read_report(spark, report, path)))
    return rows.withColumn("lost", F.lit(sum(lost)))


def users_rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of each week, month and country from the stored daily report, whose sketches went
    through changelog and table; the estimates are compared with the exact numbers."""
    root, copy = new_folder(spark, "stream"), even_events(spark, sf_dir)
    replay(spark, event_messages(spark, sf_dir, copy), lambda feed, _: _run_chain(spark, root, feed, [DAILY_USERS]))
    stored = read_report(spark, DAILY_USERS, f"{root}/{DAILY_USERS.name}")
    events = event_records(spark, sf_dir, copy).withColumn("ts_date", F.col("ts_date").cast("date"))
    spans = {
        "week": F.date_trunc("week", "ts_date").cast("date").cast("string"),
        "month": F.date_trunc("month", "ts_date").cast("date").cast("string"),
        "country": F.col("country"),
    }
    found = []
    for span, key in spans.items():
        exact = events.groupBy(key.alias("period")).agg(F.count_distinct("customer_id").alias("exact"))
        both = users_over(stored, key.alias("period")).join(exact, "period", "left")
        near = F.coalesce(within_bound(F.col("users"), F.col("exact")), F.lit(False))
        found.append(both.select(F.lit(span).alias("span"), "period", near.alias("pu_in_bound")))
    return found[0].unionByName(found[1]).unionByName(found[2])


def late_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest third of the days comes before the middle one: of the days that are closed
    by then, what came later is accounted for, to the record."""
    root, feed, messages = new_folder(spark, "stream"), new_folder(spark, "feed"), sent_events(spark, sf_dir)
    first, middle, last = waves()
    for number, part in enumerate((first, last, middle)):
        append_topic_files(messages.filter(part), feed, f"wave-{number}")
        records = jobs.good(jobs.inspect(read_topic_files(spark, feed)))
        jobs.finish([jobs.start_final_days(records, root, **NOW)])
    everything = jobs.good(jobs.inspect(messages))
    account = jobs.late_rows(spark.read.parquet(f"{root}/final_days"), everything)
    return account.select("ts_date", "sent", "late")


def written_rows(rows: DataFrame, name: str) -> DataFrame:
    path = new_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _sql_tables(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """What ad-hoc SQL finds after the damaged feed was taken in; the database goes again."""
    root, database = new_folder(spark, "stream"), f"daily_report_{uuid.uuid4().hex}"

    def step(feed: str, _: int) -> None:
        jobs.finish([jobs.start_intake(read_topic_files(spark, feed), root, **NOW)])

    replay(spark, damaged_messages(spark, sf_dir, even_events(spark, sf_dir)), step)
    create_tables(spark, database, root, [])
    found = spark.sql(sql.format(database=database))
    return kept_without_database(found, database)


def sql_daily_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table as SQL sees it: every field of every good record."""
    return readable(_sql_tables(spark, sf_dir, "SELECT * FROM {database}.daily_records"))


def sql_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bad messages as SQL sees them, by reason."""
    return _sql_tables(spark, sf_dir, "SELECT reason, count(*) AS n FROM {database}.quarantine GROUP BY reason")
