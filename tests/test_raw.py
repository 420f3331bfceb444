"""The raw table: parts, folds and readers, held against plain Python."""

import json
import os
import random
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from daytally.functions.envelope import REASON
from daytally.operators.latest import latest_records
from daytally.operators.reports import DAILY_CATEGORY_PRODUCT, DAILY_PU_REV
from daytally.sources import files
from daytally.sources.files import read_topic_files
from daytally.streaming import jobs, raw
from daytally.streaming.changelog import create_tables, read_report
from tests.test_streaming import NOW, bag, batch_result, message, put, run_table


def take_in(spark, root, **options):
    jobs.finish([jobs.start_intake(read_topic_files(spark, f"{root}/feed", **options), root, **NOW)])


def read_by_report(spark, root, report, run=0):
    jobs.finish([jobs.start_report(report, jobs.stream_raw(spark, root, report, run), root, run=run, **NOW)])
    return run_table(spark, report, root)


FIELDS = ("ts_id", "ts_date", "revenue", "customer_id")


def seen(df):
    return sorted((r.ts_id, str(r.ts_date), r.revenue, r.customer_id) for r in df.select(*FIELDS).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_records_equal_what_was_sent_last_whatever_is_folded(spark, root, monkeypatch, seed):
    """Records come again with other amounts and on other days, as they are or changed, in one
    batch or over several folds; readers by function and by SQL, and reports that began before
    the first fold, between folds and at the end, agree with the messages."""
    monkeypatch.setattr(raw, "FAN", 3)
    rng, last, bad, sent = random.Random(seed), {}, 0, []
    database = f"folded_{seed}"
    for batch in range(7):
        lines = []
        for _ in range(rng.randint(1, 25)):
            kind = rng.random()
            if kind < 0.1:
                lines.append(rng.choice(["bad", ""]))
                bad += 1
            elif kind < 0.3 and sent:
                lines.append(rng.choice(sent))
            else:
                lines.append(message(rng.randrange(30), day=rng.randint(1, 3), revenue=float(rng.randint(1, 9))))
        sent += [line for line in lines if line.startswith("{")]
        for line in lines:
            if line.startswith("{"):
                r = json.loads(line)
                last[r["ts_id"]] = (r["ts_id"], r["ts_date"], r["revenue"], r["customer_id"])
        put(f"{root}/feed", f"f{batch}", lines, at=1_700_000_000 + batch)
        take_in(spark, root)
        if batch % 2 or rng.random() < 0.5:
            raw.fold(spark, root)
        if batch in (1, 4):
            read_by_report(spark, root, DAILY_CATEGORY_PRODUCT)
        assert seen(raw.read_records(spark, root)) == sorted(last.values())
        assert raw.read_quarantine(spark, root).count() == bad
    assert seen(latest_records(raw.read_raw(spark, root))) == sorted(last.values())
    create_tables(spark, database, root, [])
    assert seen(spark.table(f"{database}.daily_records")) == sorted(last.values())
    day = spark.table(f"{database}.daily_records").filter("ts_date = '2023-12-02'")
    assert seen(day) == sorted(r for r in last.values() if r[1] == "2023-12-02")
    assert spark.table(f"{database}.quarantine").count() == bad
    spark.sql(f"DROP DATABASE {database} CASCADE")
    for report, run in ((DAILY_CATEGORY_PRODUCT, 0), (DAILY_PU_REV, 0), (DAILY_PU_REV, 1)):
        got, want = bag(read_by_report(spark, root, report, run)), bag(batch_result(spark, report, f"{root}/feed"))
        assert got == want
    manifest = raw.newest_manifest(spark, root)
    ids = raw._settled(spark, root, manifest).groupBy("ts_id").count().filter("count > 1")
    assert ids.isEmpty()


def test_a_day_opens_its_segments_and_what_is_not_folded(spark, root):
    for batch in range(3):
        put(f"{root}/feed", f"f{batch}", [message(i, day=1 + i % 3) for i in range(batch * 9, batch * 9 + 9)], at=1_700_000_000 + batch)
        take_in(spark, root)
        if batch < 2:
            raw.fold(spark, root)
    create_tables(spark, "one_day", root, [])
    for rows in (raw.read_records(spark, root), spark.table("one_day.daily_records")):
        day = rows.filter("ts_date = DATE'2023-12-02'")
        assert len(day.collect()) == 9
        plan = day._jdf.queryExecution().executedPlan().toString()
        # Of the records in folds no other day's are opened.
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "newest#" in line]
        assert scans and all("ts_date#" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)
    spark.sql("DROP DATABASE one_day CASCADE")


def put_part(root, part, day, ids):
    """A finished part, as a micro-batch leaves it."""
    folder = f"{root}/intake/parts/part={part}/reason=good/ts_date=2023-12-{day:02d}"
    os.makedirs(folder)
    record = json.loads(message(0))
    columns = {f.name: [record.get(f.name) if f.name in ("customer_id", "category") else None] * len(ids) for f in raw.intake_schema() if f.name not in ("part", "reason", "ts_date")}
    columns |= {"ts_id": ids, "offset": [part] * len(ids)}
    kinds = {"ts": pa.timestamp("us", "UTC"), "arrived_at": pa.timestamp("us", "UTC"), "offset": pa.int64(), "quantity": pa.int32(), "price": pa.float32(), "revenue": pa.float32(), "profit": pa.float32()}
    pq.write_table(pa.table({n: pa.array(v, kinds.get(n, pa.string())) for n, v in columns.items()}), f"{folder}/part-0.parquet")
    open(f"{root}/intake/parts/part={part}/_SUCCESS", "w").close()


def test_files_do_not_grow_with_batches(spark, root):
    """A thousand small batches on two days, a third of the records sent again: what is listed
    stays within a bound, and the sent ones are merged away."""
    listed = []
    for batch in range(1000):
        put_part(root, batch, 1 + batch // 500, [f"id{batch}", f"id{batch // 3}"])
        if batch % 100 == 99:
            raw.fold(spark, root)
            listed.append(sum(n.endswith(".parquet") for _, _, names in os.walk(f"{root}/intake") for n in names))
    # Two days of at most FAN - 1 segments a tier, their forerunners until the next fold, and
    # the parts of two folds.
    assert max(listed) <= 200 + 2 * 2 * 2 * raw.FAN
    got = raw.read_records(spark, root)
    assert got.count() == 1000 == got.select("ts_id").distinct().count()
    assert got.filter("ts_date = '2023-12-02'").count() == 500 + 168  # ids 166..333 came again on that day
    assert raw._segments(spark, root, raw.newest_manifest(spark, root)).agg(F.sum("sent")).first()[0] == 2000


def test_a_hot_day_is_split_by_its_size(spark, root):
    rows = spark.range(60_000).select(
        *[F.concat(F.lit(n), F.sha2(F.col("id").cast("string"), 256)).alias(n) for n in ("ts_id", "customer_name")],
        F.lit("good").alias(REASON),
        F.when(F.col("id") % 3 == 0, F.lit("2023-12-01")).otherwise(F.concat(F.lit("2023-11-"), F.format_string("%02d", 1 + F.col("id") % 28))).cast("date").alias("ts_date"),
    ).repartition(8)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        raw.write_part(rows, root, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {d: [n for n in os.listdir(f"{root}/intake/parts/part=0/reason=good/{d}") if n.endswith(".parquet")] for d in os.listdir(f"{root}/intake/parts/part=0/reason=good")}
    # Days that fall into the hot one's shuffle partition are split along with it.
    assert len(files["ts_date=2023-12-01"]) >= 4
    assert sum(len(f) <= 2 for f in files.values()) >= 14


def test_a_part_that_was_moved_in_part_is_moved_to_the_end(spark, root):
    """As on a store that renames files one by one, when the job is lost in between."""
    rows = spark.range(100).selectExpr("cast(id AS string) AS ts_id", "'good' AS reason", "date_add(DATE'2023-12-01', cast(id % 5 AS int)) AS ts_date")
    raw.write_part(rows, root, 0)
    path, aside = f"{root}/intake/parts/part=0", f"{root}/intake/staging/part=0"
    names = sorted(os.path.relpath(os.path.join(d, n), path) for d, _, own in os.walk(path) for n in own if n.endswith(".parquet"))
    shutil.move(path, aside)
    for name in names[:2]:
        os.makedirs(os.path.dirname(f"{path}/{name}"))
        os.rename(f"{aside}/{name}", f"{path}/{name}")
    raw.write_part(rows, root, 0)
    assert sorted(os.path.relpath(os.path.join(d, n), path) for d, _, own in os.walk(path) for n in own if n.endswith(".parquet")) == names
    assert not os.path.exists(aside) and raw.complete_parts(spark, root) == [0]
    raw.write_part(rows, root, 0)
    assert spark.read.parquet(path).count() == 100


def test_parts_wait_for_a_report_that_is_behind(spark, root):
    put(f"{root}/feed", "f0", [message(0)], at=1_700_000_000)
    take_in(spark, root)
    read_by_report(spark, root, DAILY_PU_REV)
    for batch in range(1, 5):
        put(f"{root}/feed", f"f{batch}", [message(batch)], at=1_700_000_000 + batch)
        take_in(spark, root)
        raw.fold(spark, root)
    assert raw.complete_parts(spark, root) == [4, 3, 2, 1, 0]
    assert [r.daily_rev for r in read_by_report(spark, root, DAILY_PU_REV).collect()] == [40.0]
    for batch in range(5, 8):
        put(f"{root}/feed", f"f{batch}", [message(batch)], at=1_700_000_000 + batch)
        take_in(spark, root)
        raw.fold(spark, root)
        assert [r.daily_rev for r in read_by_report(spark, root, DAILY_PU_REV).collect()] == [8.0 * (batch + 1)]
    assert min(raw.complete_parts(spark, root)) >= 3
    assert read_report(spark, DAILY_PU_REV, f"{root}/daily_pu_rev").count() == 1


def test_a_fold_hashes_records_and_sorts_none(spark, root):
    put(f"{root}/feed", "0", [message(1), message(1), message(2)])
    take_in(spark, root)
    rows = raw.read_parts(spark, root).withColumns({raw.SENT: F.lit(1).cast("long"), raw.NEWEST: F.lit(False)})
    counted = raw._counted(rows)
    assert "SortAggregate" not in counted._jdf.queryExecution().executedPlan().toString()
    assert sorted(r[raw.SENT] for r in counted.collect()) == [1, 2]


def test_topic_files_have_row_groups_for_many_readers(spark, root, monkeypatch):
    monkeypatch.setattr(files, "ROW_GROUP_BYTES", 64 * 1024)
    rows = spark.range(0, 20_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("value"))
    files.append_topic_files(rows, f"{root}/topic", "0")
    (name,) = [n for n in os.listdir(f"{root}/topic/send=0") if n.endswith(".parquet")]
    assert pq.ParquetFile(f"{root}/topic/send=0/{name}").num_row_groups > 4
    assert files.topic_messages(spark, f"{root}/topic").count() == 20_000
