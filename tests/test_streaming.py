import datetime
import itertools
import json
import os
import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from daytally.functions.envelope import RAW, REASON, good, inspect
from daytally.operators.latest import fold_of, latest_records, run_of, version_of
from daytally.operators.reports import DAILY_ADDRESS, DAILY_CATEGORY_PRODUCT, DAILY_PU_REV, DAILY_USERS, REPORTS, users_over
from daytally.sources.files import read_topic_files, topic_messages
from daytally.session import MARKER_SETTING
from daytally.streaming import jobs
from daytally.streaming.changelog import (
    as_text,
    compact,
    create_tables,
    fold_changelog,
    newest_snapshot,
    publish_ready,
    read_changelog,
    read_changes,
    read_report,
    to_report_types,
    write_changes,
    write_version,
)
from daytally.streaming.publication import published_runs

NOW = jobs.AVAILABLE_NOW


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def message(i, day=1, revenue=8.0, **changes):
    record = {
        "ts_id": f"id{i}",
        "ts": f"2023-12-{day:02d} {i % 24:02d}:00:00",
        "ts_date": f"2023-12-{day:02d}",
        "customer_id": f"c{i % 5}",
        "customer_name": "n",
        "segment": "s",
        "country": "x",
        "city": "y",
        "category": "k",
        "sub_category": "l",
        "product_name": f"p{i % 3}",
        "price": 4.0,
        "quantity": 2,
        "discount": "0.5",
        "revenue": revenue,
        "profit": revenue / 2,
        "latitude": float(i % 2),
        "longitude": 1.5,
    }
    return json.dumps({**record, **changes})


OFFSETS = itertools.count()


def put(folder, name, lines, at=None):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.parquet"
    offsets = [next(OFFSETS) for _ in lines]
    pq.write_table(pa.table({"key": pa.nulls(len(lines), pa.string()), "value": lines, "offset": offsets}), path)
    if at is not None:
        os.utime(path, (at, at))


def run_report(spark, report, root, feed, run=0, **options):
    records = jobs.records_of(read_topic_files(spark, feed, **options))
    query = jobs.start_report(report, records, root, run=run, **NOW)
    jobs.finish([query])
    return query


def run_table(spark, report, root, run=0):
    jobs.finish([jobs.start_consumer(spark, report, root, run=run, **NOW)])
    return read_report(spark, report, f"{root}/{report.name}")


def batch_result(spark, report, feed, exact=False):
    rows = report.aggregate(good(inspect(topic_messages(spark, feed))), exact)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in report.schema])


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10**6), files=st.integers(2, 6))
def test_any_split_and_order_gives_the_batch_result(spark, tmp_path_factory, seed, files):
    root = str(tmp_path_factory.mktemp("any"))
    rng = random.Random(seed)
    lines = [message(i, day=rng.randint(1, 9), revenue=rng.randint(1, 99) / 4) for i in range(60)]
    rng.shuffle(lines)
    for n in range(files):
        put(f"{root}/feed", f"f{n}", lines[n::files], at=1_700_000_000 + rng.randint(0, 1000))
    for report in REPORTS.values():
        run_report(spark, report, root, f"{root}/feed", maxFilesPerTrigger="1")
        assert len(os.listdir(f"{root}/{report.name}/changelog")) >= files
        assert bag(run_table(spark, report, root)) == bag(batch_result(spark, report, f"{root}/feed"))


def test_changelog_holds_totals_so_far_and_only_changed_keys(spark, root):
    put(f"{root}/feed", "a", [message(1, day=1), message(2, day=2)], at=1_700_000_000)
    put(f"{root}/feed", "b", [message(3, day=2)], at=1_700_000_100)
    run_report(spark, DAILY_PU_REV, root, f"{root}/feed", maxFilesPerTrigger="1")
    rows = read_changelog(spark, f"{root}/daily_pu_rev/changelog")
    sent = sorted((r.version, json.loads(r.value)["ts_date"], json.loads(r.value)["daily_rev"]) for r in rows.collect())
    first, second = version_of(0, 0), version_of(0, 1)
    assert sent == [(first, "2023-12-01", 8.0), (first, "2023-12-02", 8.0), (second, "2023-12-02", 16.0)]


def test_a_small_batch_is_one_file(spark, root):
    """The state is in several partitions; their few rows are not written to as many files."""
    put(f"{root}/feed", "a", [message(i, day=1 + i) for i in range(20)])
    query = run_report(spark, DAILY_PU_REV, root, f"{root}/feed")
    assert len(query.recentProgress) == 1
    path = f"{root}/daily_pu_rev/changelog"
    assert os.listdir(path) == ["version=0"]
    assert len([n for n in os.listdir(f"{path}/version=0") if n.endswith(".parquet")]) == 1


def test_late_record_counts(spark, root):
    put(f"{root}/feed", "a", [message(1, day=20)], at=1_700_000_000)
    put(f"{root}/feed", "b", [message(2, day=21)], at=1_700_000_100)
    put(f"{root}/feed", "c", [message(3, day=10)], at=1_700_000_200)
    query = run_report(spark, DAILY_PU_REV, root, f"{root}/feed", maxFilesPerTrigger="1")
    dropped = [s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]]
    assert dropped and not any(dropped)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 3
    assert [str(r.ts_date) for r in run_table(spark, DAILY_PU_REV, root).orderBy("ts_date").collect()] == [
        "2023-12-10",
        "2023-12-20",
        "2023-12-21",
    ]


def test_final_days_drop_what_comes_after_the_close(spark, root):
    def step():
        records = good(inspect(read_topic_files(spark, f"{root}/feed")))
        jobs.finish([jobs.start_final_days(records, root, **NOW)])
        return bag(spark.read.parquet(f"{root}/final_days").selectExpr("cast(ts_date as string)", "daily_rev"))

    put(f"{root}/feed", "a", [message(5, day=d) for d in (1, 2, 4)])
    assert step() == [("2023-12-01", 8.0), ("2023-12-02", 8.0)]
    put(f"{root}/feed", "b", [message(6, day=1), message(7, day=4), message(8, day=7)])
    assert step() == [("2023-12-01", 8.0), ("2023-12-02", 8.0), ("2023-12-04", 16.0)]


def test_dropped_plus_counted_is_sent(spark, root):
    def step():
        jobs.finish([jobs.start_final_days(good(inspect(read_topic_files(spark, f"{root}/feed"))), root, **NOW)])

    put(f"{root}/feed", "a", [message(i, day=d) for i in range(3) for d in (1, 2, 6)], at=1_700_000_000)
    step()
    put(f"{root}/feed", "b", [message(i, day=d) for i in range(10, 14) for d in (1, 3, 6, 9)], at=1_700_000_001)
    step()
    sent = good(inspect(topic_messages(spark, f"{root}/feed")))
    account = jobs.late_rows(spark.read.parquet(f"{root}/final_days"), sent).orderBy("ts_date").collect()
    assert [(r.ts_date.day, r.sent, r.counted, r.late) for r in account] == [(1, 7, 3, 4), (2, 3, 3, 0), (3, 4, 0, 4), (6, 7, 7, 0)]
    create_tables(spark, "closed", root, [])
    assert spark.sql("SELECT sum(n_records) FROM closed.final_days").first()[0] == 13
    spark.sql("DROP DATABASE closed CASCADE")


def test_users_roll_up_over_days_and_countries(spark, root):
    """Each user comes on many days; the daily numbers add up to far more than there are."""
    lines = [message(i, day=1 + i % 9, customer_id=f"c{i % 400}", country=f"k{i % 2}") for i in range(3000)]
    for n in range(2):
        put(f"{root}/feed", f"f{n}", lines[n::2], at=1_700_000_000 + n)
        run_report(spark, DAILY_USERS, root, f"{root}/feed")
        table = run_table(spark, DAILY_USERS, root)
    compact(spark, DAILY_USERS, f"{root}/daily_users")
    stored = read_report(spark, DAILY_USERS, f"{root}/daily_users")
    assert stored.schema == table.schema == DAILY_USERS.schema and stored.count() == 18
    assert abs(users_over(stored).first().users - 400) <= 40
    assert all(abs(r.users - 200) <= 20 for r in users_over(stored, F.col("country")).collect())
    create_tables(spark, "people", root, [DAILY_USERS])
    by_sql = spark.sql("SELECT hll_sketch_estimate(hll_union_agg(users)) FROM people.daily_users WHERE ts_date <= '2023-12-04'").first()[0]
    assert abs(by_sql - 400) <= 40
    assert spark.table("people.daily_users_text").schema["users"].dataType.simpleString() == "string"
    spark.sql("DROP DATABASE people CASCADE")


def test_restart_goes_on_from_the_checkpoint(spark, root):
    put(f"{root}/feed", "a", [message(i) for i in range(5)])
    run_report(spark, DAILY_CATEGORY_PRODUCT, root, f"{root}/feed")
    put(f"{root}/feed", "b", [message(i) for i in range(5, 9)])
    run_report(spark, DAILY_CATEGORY_PRODUCT, root, f"{root}/feed")
    result = run_table(spark, DAILY_CATEGORY_PRODUCT, root)
    assert bag(result) == bag(batch_result(spark, DAILY_CATEGORY_PRODUCT, f"{root}/feed"))


def test_fresh_start_needs_a_higher_run(spark, root):
    put(f"{root}/feed", "a", [message(1)])
    run_report(spark, DAILY_PU_REV, root, f"{root}/feed")
    os.rename(f"{root}/checkpoints", f"{root}/lost")
    with pytest.raises(ValueError, match="higher run"):
        run_report(spark, DAILY_PU_REV, root, f"{root}/feed")
    put(f"{root}/feed", "b", [message(2)])
    run_report(spark, DAILY_PU_REV, root, f"{root}/feed", run=1)
    assert [r.daily_rev for r in run_table(spark, DAILY_PU_REV, root).collect()] == [16.0]


def test_fresh_consumer_needs_a_higher_run(spark, root):
    put(f"{root}/feed", "a", [message(1)])
    run_report(spark, DAILY_PU_REV, root, f"{root}/feed")
    run_table(spark, DAILY_PU_REV, root)
    os.rename(f"{root}/checkpoints/table-daily_pu_rev-0", f"{root}/lost")
    put(f"{root}/feed", "b", [message(2)])
    run_report(spark, DAILY_PU_REV, root, f"{root}/feed")
    with pytest.raises(ValueError, match="higher run"):
        run_table(spark, DAILY_PU_REV, root)
    assert [r.daily_rev for r in run_table(spark, DAILY_PU_REV, root, run=1).collect()] == [16.0]


def test_raw_table_refuses_a_lost_checkpoint(spark, root):
    put(f"{root}/feed", "a", [message(1)])
    start = lambda: jobs.start_intake(read_topic_files(spark, f"{root}/feed"), root, **NOW)
    jobs.finish([start()])
    os.rename(f"{root}/checkpoints", f"{root}/lost")
    with pytest.raises(ValueError, match="checkpoint is gone"):
        start()


def test_raw_keeps_one_row_per_id_while_reports_count_twice(spark, root):
    put(f"{root}/feed", "a", [message(1), message(2)])
    put(f"{root}/feed", "b", [message(1)])
    jobs.finish([jobs.start_intake(read_topic_files(spark, f"{root}/feed"), root, **NOW)])
    assert jobs.read_raw(spark, root).count() == 3
    assert latest_records(jobs.read_raw(spark, root)).count() == 2
    jobs.finish([jobs.start_report(DAILY_PU_REV, jobs.stream_raw(spark, root, DAILY_PU_REV), root, **NOW)])
    assert [r.daily_rev for r in run_table(spark, DAILY_PU_REV, root).collect()] == [24.0]


def test_a_resent_record_replaces_the_first(spark, root):
    for name, revenue in (("a", 8.0), ("b", 12.0)):
        put(f"{root}/feed", name, [message(1, revenue=revenue)])
        jobs.finish([jobs.start_intake(read_topic_files(spark, f"{root}/feed"), root, **NOW)])
    assert [r.revenue for r in latest_records(jobs.read_raw(spark, root)).collect()] == [12.0]


@pytest.mark.parametrize("together", [True, False])
def test_the_last_message_wins_whatever_the_clock_says(spark, root, together):
    """In one micro-batch or two, and when the second comes with an earlier time."""
    later = [message(1, revenue=20.0)]
    put(f"{root}/feed", "a", [message(1, revenue=50.0), *(later if together else [])], at=1_700_000_000)
    jobs.finish([jobs.start_intake(read_topic_files(spark, f"{root}/feed"), root, **NOW)])
    if not together:
        put(f"{root}/feed", "b", later, at=1_699_990_000)
        jobs.finish([jobs.start_intake(read_topic_files(spark, f"{root}/feed"), root, **NOW)])
    raw = jobs.read_raw(spark, root)
    assert [r.revenue for r in latest_records(raw).collect()] == [20.0]
    turned = raw.withColumn("arrived_at", F.when(F.col("revenue") == 50, F.current_timestamp()).otherwise(F.lit("2000-01-01").cast("timestamp")))
    assert [r.revenue for r in latest_records(turned).collect()] == [20.0]


def test_bad_messages_go_to_quarantine_and_leave_totals_alone(spark, root):
    put(f"{root}/feed", "a", [message(1), "not json", "", message(2, quantity="x"), message(3, ts_date=None)])
    jobs.finish([jobs.start_intake(read_topic_files(spark, f"{root}/feed"), root, **NOW)])
    kept = jobs.read_quarantine(spark, root)
    assert {r[REASON]: r["count"] for r in kept.groupBy(REASON).count().collect()} == {
        "malformed": 2,
        "empty": 1,
        "incomplete": 1,
    }
    assert kept.filter(F.col(RAW) == "not json").count() == 1
    assert [r.ts_id for r in jobs.read_raw(spark, root).collect()] == ["id1"]
    run_report(spark, DAILY_PU_REV, root, f"{root}/feed")
    assert [r.daily_rev for r in run_table(spark, DAILY_PU_REV, root).collect()] == [8.0]


def test_service_takes_files_as_they_come(spark, root):
    """Default trigger, all jobs at once: intake, three reports, three consumers."""
    feed = f"{root}/feed"
    put(feed, "a", [message(i, day=1 + i % 4) for i in range(20)])
    intake = jobs.start_intake(read_topic_files(spark, feed), root)
    reports = [jobs.start_report(r, jobs.stream_raw(spark, root, r), root) for r in REPORTS.values()]
    consumers = [jobs.start_consumer(spark, r, root) for r in REPORTS.values()]
    try:
        put(f"{root}/staging", "b", ["bad", *[message(i, day=3) for i in range(20, 30)]])
        os.rename(f"{root}/staging/b.parquet", f"{feed}/b.parquet")
        for stage in ([intake], reports, consumers):
            for query in stage:
                query.processAllAvailable()
    finally:
        jobs.stop([intake, *reports, *consumers])
    for report in REPORTS.values():
        got = read_report(spark, report, f"{root}/{report.name}")
        assert bag(got) == bag(batch_result(spark, report, feed))


def test_raw_read_prunes_by_day(spark, root):
    put(f"{root}/feed", "a", [message(1, day=1), message(2, day=2), "bad"])
    jobs.finish([jobs.start_intake(read_topic_files(spark, f"{root}/feed"), root, **NOW)])
    day = latest_records(jobs.read_raw(spark, root), resent_same_day=True).filter("ts_date = DATE'2023-12-02'")
    assert [r.ts_id for r in day.collect()] == ["id2"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reason" in plan


def test_replay_of_the_whole_changelog_changes_nothing(spark, root):
    put(f"{root}/feed", "a", [message(i, day=1 + i % 3) for i in range(9)])
    run_report(spark, DAILY_ADDRESS, root, f"{root}/feed")
    first = bag(run_table(spark, DAILY_ADDRESS, root))
    rows = read_changes(spark, DAILY_ADDRESS, f"{root}/daily_address").count()
    assert bag(run_table(spark, DAILY_ADDRESS, root, run=1)) == first
    assert read_changes(spark, DAILY_ADDRESS, f"{root}/daily_address").count() == 2 * rows


def test_rerun_of_a_batch_leaves_its_files(spark, root):
    rows = spark.createDataFrame([("2023-12-01", 1.0)], "ts_date string, daily_rev double")
    write_version(rows, root, 0, 3)
    before = sorted(os.listdir(f"{root}/version={version_of(0, 3)}"))
    write_version(rows, root, 0, 3)
    assert sorted(os.listdir(f"{root}/version={version_of(0, 3)}")) == before
    assert read_changelog(spark, root).count() == 1


@pytest.mark.parametrize("written", [True, False])
def test_crash_before_the_commit(spark, root, written):
    """The last batch runs again, whether or not its changelog folder was complete."""
    feed, name = f"{root}/feed", f"report-{DAILY_CATEGORY_PRODUCT.name}"
    for n in range(2):
        put(feed, f"f{n}", [message(i) for i in range(n, n + 4)], at=1_700_000_000 + n)
    run_report(spark, DAILY_CATEGORY_PRODUCT, root, feed, maxFilesPerTrigger="1")
    commits = f"{root}/checkpoints/{name}/commits"
    assert max(int(n) for n in os.listdir(commits) if n.isdigit()) == 1
    for n, file in enumerate(("1", ".1.crc")):
        os.rename(f"{commits}/{file}", f"{root}/lost-commit-{n}")
    if not written:
        os.rename(f"{root}/{DAILY_CATEGORY_PRODUCT.name}/changelog/version={version_of(0, 1)}/_SUCCESS", f"{root}/lost-marker")
    put(feed, "f2", [message(i, day=2) for i in range(4)])
    run_report(spark, DAILY_CATEGORY_PRODUCT, root, feed, maxFilesPerTrigger="1")
    assert bag(run_table(spark, DAILY_CATEGORY_PRODUCT, root)) == bag(batch_result(spark, DAILY_CATEGORY_PRODUCT, feed))


def test_unfinished_batch_is_written_again(spark, root):
    rows = spark.createDataFrame([("2023-12-01", 1.0)], "ts_date string, daily_rev double")
    write_version(rows, root, 0, 3)
    os.rename(f"{root}/version={version_of(0, 3)}/_SUCCESS", f"{root}/marker")
    write_version(rows, root, 0, 3)
    assert read_changelog(spark, root).count() == 1


def test_failure_in_one_query_is_raised(spark, root):
    put(f"{root}/feed", "a", [message(1)])
    records = jobs.records_of(read_topic_files(spark, f"{root}/feed"))

    def fail(rows, batch):
        raise RuntimeError("no room")

    writer = records.writeStream.foreachBatch(fail).option("checkpointLocation", f"{root}/checkpoints/fail")
    healthy = jobs.start_intake(read_topic_files(spark, f"{root}/feed"), root)
    with pytest.raises(StreamingQueryException, match="no room"):
        jobs.serve(spark, [healthy, writer.start()])
    assert not healthy.isActive
    spark.streams.resetTerminated()


# Runs that are published when they have caught up


@pytest.mark.parametrize("report", REPORTS.values(), ids=list(REPORTS))
def test_a_fresh_run_is_seen_only_when_it_has_caught_up(spark, root, report):
    """A reader looks between all batches of a fresh run, by function and by SQL: it sees what
    it saw before, until all totals are there; then the new ones, with the latest records."""
    feed, path, database = f"{root}/feed", f"{root}/{report.name}", f"seen_{report.name}"
    for n in range(3):
        put(feed, f"f{n}", [message(i, day=1 + i % 3) for i in range(n * 4, n * 4 + 4)], at=1_700_000_000 + n)
    run_report(spark, report, root, feed)
    before = bag(run_table(spark, report, root))
    put(feed, "f3", [message(i, day=2) for i in range(20, 25)], at=1_700_000_100)
    after, seen, sunk = bag(batch_result(spark, report, feed)), [], []

    def look(_):
        query = jobs.start_consumer(spark, report, root, sink=lambda rows: sunk.extend(run_of(r.version) for r in rows.collect()), **NOW)
        jobs.finish([query])
        create_tables(spark, database, root, [report])
        seen.append(bag(read_report(spark, report, path)))
        assert bag(spark.table(f"{database}.{report.name}")) == seen[-1]
        if len(seen) == 2:
            compact(spark, report, path)
            fold_changelog(spark, report, f"{path}/changelog")

    records = jobs.records_of(read_topic_files(spark, feed, maxFilesPerTrigger="1"))
    jobs.finish([jobs.start_report(report, records, root, run=1, send=look, **NOW)])
    assert len(seen) == 4 and all(rows == before != after for rows in seen)
    assert 1 not in sunk
    look(None)
    assert seen[-1] == after and sunk.count(1) >= len(after)
    compact(spark, report, path)
    assert bag(run_table(spark, report, root, run=1)) == after
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_a_run_that_crashed_stays_hidden_and_the_old_one_goes_on(spark, root):
    feed, path = f"{root}/feed", f"{root}/daily_pu_rev"
    for n in range(2):
        put(feed, f"f{n}", [message(n)], at=1_700_000_000 + n)
    run_report(spark, DAILY_PU_REV, root, feed)
    run_table(spark, DAILY_PU_REV, root)
    crashes = [True]

    def fail(_):
        if crashes.pop():
            raise RuntimeError("lost")
        crashes.append(False)

    start = lambda: jobs.start_report(
        DAILY_PU_REV, jobs.records_of(read_topic_files(spark, feed, maxFilesPerTrigger="1")), root, run=1, send=fail, **NOW
    )
    with pytest.raises(StreamingQueryException, match="lost"):
        start()
    assert [r.daily_rev for r in run_table(spark, DAILY_PU_REV, root).collect()] == [16.0]
    put(feed, "f2", [message(2)], at=1_700_000_100)
    run_report(spark, DAILY_PU_REV, root, feed)
    assert [r.daily_rev for r in run_table(spark, DAILY_PU_REV, root).collect()] == [24.0]
    assert published_runs(spark, path) == [0]
    crashes.append(False)
    jobs.finish([start()])
    assert [r.daily_rev for r in run_table(spark, DAILY_PU_REV, root).collect()] == [24.0]
    publish_ready(spark, DAILY_PU_REV, path)
    assert published_runs(spark, path) == [1, 0]


# Keyed tables


@pytest.mark.parametrize("report", REPORTS.values(), ids=list(REPORTS))
def test_a_lower_run_goes_on_after_compaction(spark, root, report):
    """Run 1 reads all again, a snapshot is made of both runs, and run 0 gets the next wave."""
    path, feed = f"{root}/{report.name}", f"{root}/feed"
    for n in range(2):
        put(feed, f"f{n}", [message(i, day=1 + i % 3) for i in range(n, n + 6)])
        run_report(spark, report, root, feed)
        run_table(spark, report, root, run=0)
    run_table(spark, report, root, run=1)
    assert compact(spark, report, path).parts == (version_of(0, 1), version_of(1, 0))
    put(feed, "f2", [message(i, day=1 + i % 3, revenue=100.0) for i in range(9)])
    run_report(spark, report, root, feed)
    want = bag(batch_result(spark, report, feed))
    assert bag(run_table(spark, report, root, run=0)) == want
    database = f"runs_{report.name}"
    create_tables(spark, database, root, [report])
    assert bag(spark.table(f"{database}.{report.name}")) == want
    compact(spark, report, path)
    create_tables(spark, database, root, [report])
    assert bag(spark.table(f"{database}.{report.name}")) == want
    spark.sql(f"DROP DATABASE {database} CASCADE")


def put_part(folder, number, table):
    """A finished folder of one row, as a micro-batch leaves it."""
    os.makedirs(f"{folder}={number}")
    pq.write_table(table, f"{folder}={number}/part-0.parquet")
    open(f"{folder}={number}/_SUCCESS", "w").close()


def test_folders_do_not_grow_with_batches(spark, root):
    """Of a thousand small batches, folded every 64, a reader lists no more folders in the
    end than near the beginning."""
    day, listed = datetime.date(2023, 12, 1), []
    for batch in range(1000):
        version = version_of(0, batch)
        value = json.dumps({"ts_date": "2023-12-01", "daily_pu": batch, "daily_rev": 1.0, "daily_profit": 1.0})
        put_part(f"{root}/changelog/version", version, pa.table({"value": [value]}))
        typed = {"ts_date": [day], "daily_pu": [batch], "daily_rev": [1.0], "daily_profit": [1.0], "version": [version]}
        put_part(f"{root}/changes/part", version, pa.table(typed))
        if batch % jobs.FOLD_EVERY == jobs.FOLD_EVERY - 1:
            fold_changelog(spark, DAILY_PU_REV, f"{root}/changelog")
            compact(spark, DAILY_PU_REV, root)
            listed.append(sum(len(os.listdir(f"{root}/{d}")) for d in ("changelog", "changes", "snapshots")))
    assert max(listed) == max(listed[:3]) < 5 * jobs.FOLD_EVERY
    assert [r.daily_pu for r in read_report(spark, DAILY_PU_REV, root).collect()] == [999]
    kept = read_changelog(spark, f"{root}/changelog").orderBy(F.desc("version")).first()
    assert json.loads(kept.value)["daily_pu"] == 999


def test_a_fold_stands_for_its_versions(spark, root):
    report, path = DAILY_PU_REV, f"{root}/daily_pu_rev/changelog"
    put(f"{root}/feed", "a", [message(1, day=1)])
    run_report(spark, report, root, f"{root}/feed")
    run_table(spark, report, root)
    put(f"{root}/feed", "b", [message(2, day=1), message(3, day=2)])
    run_report(spark, report, root, f"{root}/feed")
    fold = fold_changelog(spark, report, path)
    assert fold == fold_of(version_of(0, 1))
    assert fold_changelog(spark, report, path) == fold
    put(f"{root}/feed", "c", [message(4, day=3)])
    run_report(spark, report, root, f"{root}/feed")
    fold_changelog(spark, report, path)
    assert sorted(int(d.split("=")[1]) for d in os.listdir(path) if "=" in d) == [fold, version_of(0, 2), fold_of(version_of(0, 2))]
    want = bag(batch_result(spark, report, f"{root}/feed"))
    assert bag(run_table(spark, report, root)) == want
    assert bag(run_table(spark, report, root, run=1)) == want


def test_markers_must_be_on(spark, root):
    conf = spark._jsc.hadoopConfiguration()
    conf.set(MARKER_SETTING, "false")
    try:
        with pytest.raises(RuntimeError, match=MARKER_SETTING):
            write_version(spark.range(1).toDF("x"), root, 0, 0)
    finally:
        conf.unset(MARKER_SETTING)


def test_intake_and_text_by_sql(spark, root):
    put(f"{root}/feed", "a", [message(1, revenue=5.0), message(1, revenue=3.0), message(2), "bad"])
    jobs.finish([jobs.start_intake(read_topic_files(spark, f"{root}/feed"), root, **NOW)])
    write_changes(DAILY_PU_REV, changes(spark, [("2023-12-01", 1, 1.5, 1.0, 0)]), f"{root}/daily_pu_rev/changes", 0, 0)
    create_tables(spark, "raw_shop", root, [DAILY_PU_REV])
    assert bag(spark.sql("SELECT ts_id, revenue FROM raw_shop.daily_records")) == [("id1", 3.0), ("id2", 8.0)]
    assert bag(spark.sql("SELECT reason, raw_value FROM raw_shop.quarantine")) == [("malformed", "bad")]
    assert bag(spark.table("raw_shop.daily_pu_rev_text")) == [("2023-12-01", "1", "1.5", "1.0")]
    spark.sql("DROP DATABASE raw_shop CASCADE")


def changes(spark, rows):
    return spark.createDataFrame(rows, "ts_date string, daily_pu bigint, daily_rev double, daily_profit double, "
                                       "version bigint").withColumn("ts_date", F.to_date("ts_date"))


def test_compaction_keeps_the_report_and_later_versions(spark, root):
    def add(rows, batch):
        write_changes(DAILY_PU_REV, changes(spark, rows), f"{root}/changes", 0, batch)

    def users():
        return [r.daily_pu for r in read_report(spark, DAILY_PU_REV, root).orderBy("ts_date").collect()]

    assert compact(spark, DAILY_PU_REV, root) is None
    add([("2023-12-01", 1, 1.0, 1.0, 1), ("2023-12-02", 1, 1.0, 1.0, 1)], 0)
    add([("2023-12-01", 2, 2.0, 2.0, 2)], 1)
    before = bag(read_report(spark, DAILY_PU_REV, root))
    assert compact(spark, DAILY_PU_REV, root).parts == (version_of(0, 1),)
    assert newest_snapshot(spark, root).parts == (version_of(0, 1),)
    assert bag(read_report(spark, DAILY_PU_REV, root)) == before
    assert read_changes(spark, DAILY_PU_REV, root).count() == 2
    add([("2023-12-02", 5, 5.0, 5.0, 4)], 2)
    add([("2023-12-01", 9, 9.0, 9.0, 1)], 3)  # an old version that arrives late
    assert users() == [2, 5]
    assert compact(spark, DAILY_PU_REV, root).parts == (version_of(0, 3),)
    assert users() == [2, 5]
    assert compact(spark, DAILY_PU_REV, root).number == 1


def test_parts_in_the_snapshot_are_not_opened(spark, root):
    for batch in range(2):
        write_changes(DAILY_PU_REV, changes(spark, [("2023-12-01", 1, 1.0, 1.0, batch)]), f"{root}/changes", 0, batch)
    compact(spark, DAILY_PU_REV, root)
    plan = read_report(spark, DAILY_PU_REV, root)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*part#", plan)


def test_unfinished_part_stays_out_of_the_snapshot(spark, root):
    for batch in range(2):
        write_changes(DAILY_PU_REV, changes(spark, [("2023-12-01", 1, 1.0, 1.0, batch)]), f"{root}/changes", 0, batch)
    os.rename(f"{root}/changes/part={version_of(0, 1)}/_SUCCESS", f"{root}/marker")
    assert compact(spark, DAILY_PU_REV, root).parts == (0,)
    assert read_changes(spark, DAILY_PU_REV, root).count() == 2


def test_write_changes_reduces_to_one_row_per_key(spark, root):
    rows = [("2023-12-01", n, float(n), float(n), n) for n in (2, 3, 1)]
    write_changes(DAILY_PU_REV, changes(spark, rows), f"{root}/changes", 0, 0)
    assert bag(read_changes(spark, DAILY_PU_REV, root).select("daily_pu", "version")) == [(3, 3)]


def test_totals_that_are_no_numbers_are_set_aside(spark, root):
    rows = [
        ('{"ts_date":"2023-12-01","daily_pu":"3","daily_rev":"1.5","daily_profit":2}', 0),
        ('{"ts_date":"2023-12-01","daily_pu":"many","daily_rev":"1.5"}', 0),
        ('{"daily_pu":"3"}', 0),
        ("{", 0),
    ]
    spark.createDataFrame(rows, "value string, version bigint").write.partitionBy("version").parquet(
        f"{root}/daily_pu_rev/changelog"
    )
    typed = to_report_types(DAILY_PU_REV, read_changelog(spark, f"{root}/daily_pu_rev/changelog"))
    assert sorted(str(r[REASON]) for r in typed.collect()) == ["None", "incomplete", "malformed", "wrong type"]
    kept = run_table(spark, DAILY_PU_REV, root)
    assert bag(kept.selectExpr("cast(ts_date as string)", "daily_pu", "daily_rev", "daily_profit")) == [
        ("2023-12-01", 3, 1.5, 2.0)
    ]
    assert kept.schema == DAILY_PU_REV.schema
    jobs.finish([jobs.start_rejects(spark, DAILY_PU_REV, root, **NOW)])
    assert spark.read.parquet(f"{root}/daily_pu_rev/rejects").count() == 3
    create_tables(spark, "rejected", root, [DAILY_PU_REV])
    assert spark.sql("SELECT count(*) FROM rejected.daily_pu_rev_rejects WHERE reason = 'malformed'").first()[0] == 1
    spark.sql("DROP DATABASE rejected CASCADE")


def test_text_form(spark):
    rows = as_text(changes(spark, [("2023-12-01", 3, 1.5, 2.0, 0)]).drop("version"))
    assert bag(rows) == [("2023-12-01", "3", "1.5", "2.0")]


def test_tables_and_views(spark, root):
    path = f"{root}/daily_category_product"
    schema = "ts_date string, category string, sub_category string, product_name string, daily_quantity bigint, " \
        "daily_rev double, daily_profit double, version bigint"

    def add(batch, day, revenue):
        rows = spark.createDataFrame([(day, "k", "l", "m", 1, revenue, 1.0, batch)], schema)
        typed = rows.withColumn("ts_date", F.to_date("ts_date"))
        write_changes(DAILY_CATEGORY_PRODUCT, typed, f"{path}/changes", 0, batch)

    def day_total():
        create_tables(spark, "shop", root, list(REPORTS.values()))
        return spark.sql("SELECT sum(daily_rev) FROM shop.daily_category_product WHERE ts_date = '2023-12-01'")

    add(0, "2023-12-01", 1.0)
    assert bag(day_total()) == [(1.0,)]
    add(1, "2023-12-01", 5.0)
    add(2, "2023-12-02", 7.0)
    assert bag(day_total()) == [(5.0,)]
    assert "GreaterThan" in str(day_total()._jdf.queryExecution().executedPlan()) or "EqualTo(ts_date" in str(
        day_total()._jdf.queryExecution().executedPlan()
    )
    compact(spark, DAILY_CATEGORY_PRODUCT, path)
    assert bag(day_total()) == [(5.0,)]
    add(3, "2023-12-01", 6.0)
    assert bag(day_total()) == [(6.0,)]
    spark.sql("DROP DATABASE shop CASCADE")
