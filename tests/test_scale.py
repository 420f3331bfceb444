"""Hot keys and plan shapes: what must hold when the data is far larger."""

import threading

import pytest
from pyspark.sql import functions as F

from daytally.operators.latest import run_of
from daytally.operators.reports import DAILY_CATEGORY_PRODUCT, DAILY_PU_REV
from daytally.plans import batch, registry, stream
from daytally.session import folder_numbers, settings
from daytally.sources.files import topic_messages
from daytally.sources.tables import daily_records, table
from daytally.streaming import changelog

# Thresholds that let a few megabytes stand for the gigabytes of a real shuffle.
SMALL_LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def small_limits(spark):
    with settings(spark, SMALL_LIMITS):
        yield


@pytest.fixture(scope="module")
def hot_dir(spark, sf_dir, tmp_path_factory):
    """The tables with a third of all lines in one order, of one part, on one day."""
    path = str(tmp_path_factory.mktemp("hot"))
    for name in ("nation", "region", "customer", "part", "orders"):
        table(spark, sf_dir, name).write.parquet(f"{path}/{name}.parquet")
    lines = table(spark, sf_dir, "lineitem").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(9))))
    hot = F.pmod(F.xxhash64("l_orderkey", "l_partkey", "copy"), F.lit(3)) == 0
    first = {"l_orderkey": 1, "l_partkey": 1, "l_shipdate": "1998-06-15"}
    for column, value in first.items():
        kind = dict(lines.dtypes)[column]
        lines = lines.withColumn(f"new_{column}", F.when(hot, F.lit(value).cast(kind)).otherwise(F.col(column)))
    for column in first:
        lines = lines.withColumn(column, F.col(f"new_{column}")).drop(f"new_{column}")
    lines.drop("copy").repartition(8).write.parquet(f"{path}/lineitem.parquet")
    return path


def rounded(df):
    """Rows without the last cent: copies of a price make sums that end in half a cent."""
    exact = [c for c, kind in df.dtypes if kind != "double"]
    money = {c: F.round(F.col(c) / 10) for c, kind in df.dtypes if kind == "double" and c.startswith("daily")}
    places = [c for c, kind in df.dtypes if kind == "double" and not c.startswith("daily")]
    return sorted(map(tuple, df.select(*exact, *places, *[v.alias(c) for c, v in money.items()]).collect()))


@pytest.mark.parametrize("report", [DAILY_PU_REV, DAILY_CATEGORY_PRODUCT])
def test_hot_join_key_is_split_at_run_time(spark, hot_dir, small_limits, report):
    rows = daily_records(spark, hot_dir, report.inputs)
    result = report.aggregate(rows, exact=True)
    result._jdf.collectToPython()
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    assert "isFinalPlan=true" in plan


@pytest.mark.parametrize("name", ["daily_pu_rev", "daily_category_product", "daily_address", "upsert_daily_pu_rev"])
def test_hot_tables_give_the_same_with_and_without_broadcast(spark, hot_dir, name):
    query = registry.queries()[name]
    plain = rounded(query(spark, hot_dir))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with settings(spark, off):
        shuffled = rounded(query(spark, hot_dir))
    assert shuffled == plain
    assert plain


@pytest.mark.parametrize("name", sorted(registry.BATCH.keys() - {"daily_export"}))
def test_no_cross_join_and_no_python_rows(spark, sf_dir, name):
    plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan


def test_a_report_reaches_the_shuffle_pre_aggregated(spark, sf_dir):
    plan = registry.queries()["daily_category_product"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan.split("Exchange hashpartitioning(ts_date")[1]


def test_running_totals_read_each_table_once(spark, sf_dir):
    rows = batch.running_changelog(spark, sf_dir, DAILY_PU_REV)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


@pytest.mark.parametrize("name, tables", [("product_dim", 2), ("customer_dim", 5), ("daily_pu_rev", 2), ("list_price", 1)])
def test_no_table_is_read_in_vain(spark, sf_dir, name, tables):
    plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == tables


@pytest.mark.parametrize("report", [DAILY_PU_REV, DAILY_CATEGORY_PRODUCT])
def test_versions_to_upsert_are_computed_once(spark, sf_dir, monkeypatch, report):
    plans, write = [], batch.write_changes

    def seen(report, typed, *place):
        plans.append(typed._jdf.queryExecution().optimizedPlan().toString())
        write(report, typed, *place)

    monkeypatch.setattr(batch, "write_changes", seen)
    batch._upsert(spark, sf_dir, report)
    assert len(plans) == 3
    assert not [p for p in plans if "l_shipdate" in p]


def test_compaction_shuffles_once(spark, tmp_path, monkeypatch):
    rows = spark.range(100).selectExpr("date'2024-01-01' + int(id % 9) ts_date", "id daily_pu", "1D daily_rev", "1D daily_profit", "id version")
    changelog.write_changes(DAILY_PU_REV, rows, f"{tmp_path}/changes", 0, 0)
    plans, latest = [], changelog.latest_rows

    def seen(*given, **named):
        found = latest(*given, **named)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(changelog, "latest_rows", seen)
    changelog.compact(spark, DAILY_PU_REV, str(tmp_path))
    assert plans[0].count("Exchange") == plans[0].count("Exchange rangepartitioning") == 1


def test_report_tables_are_made_side_by_side(spark, sf_dir, monkeypatch):
    all_there, write = threading.Barrier(3, timeout=60), batch.write_version

    def wait(*given, **named):
        all_there.wait()
        write(*given, **named)

    monkeypatch.setattr(batch, "write_version", wait)
    assert registry.queries()["typed_reports"](spark, sf_dir).count()


def test_a_second_run_reads_many_files_in_a_few_batches(spark, tmp_path, monkeypatch):
    events = spark.range(0, 600, 1, 12).selectExpr(
        "id event_id", "id % 20 user_id", "timestamp'2024-01-01' + make_dt_interval(int(id % 30)) ts", "'view' event_type",
        "1.5D value", "'{\"k\": 3}' props",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    folders, new = [], stream.new_folder
    monkeypatch.setattr(stream, "new_folder", lambda session, name: folders.append(new(session, name)) or folders[-1])
    rows = registry.queries()["publish_run"](spark, str(tmp_path)).collect()
    assert len(rows) == 30 and {r.lost for r in rows} == {0}
    (root,) = [f for f in folders if "/stream-" in f]
    versions = folder_numbers(spark, f"{root}/daily_pu_rev/changelog", "version")
    assert 2 <= len([v for v in versions if run_of(v) == 1]) <= stream._BATCHES


def test_one_row_group_is_sent_by_several_tasks_in_its_order(spark, tmp_path, monkeypatch):
    events = spark.range(0, 900, 1, 1).selectExpr(
        "id * 7 % 900 event_id", "id % 20 user_id", "timestamp'2024-01-01' + make_dt_interval(int(id % 30)) ts", "'view' event_type",
        "1.5D value", "'{\"k\": 3}' props",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    sent, append = [], stream.append_topic_files

    def seen(messages, path, send):
        sent.append((messages.groupBy(F.spark_partition_id()).count().count(), path))
        append(messages, path, send)

    monkeypatch.setattr(stream, "append_topic_files", seen)
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        rows = registry.queries()["stream_fanout"](spark, str(tmp_path)).collect()
    assert len([r for r in rows if r.report == "daily_pu_rev"]) == 30
    assert sum(r.daily_quantity or 0 for r in rows) == 900 * 3
    assert [tasks > 1 for tasks, _ in sent] == [True] * 3
    messages = topic_messages(spark, sent[0][1]).orderBy("offset").collect()
    assert len({m.offset for m in messages}) == 900
    table_order = [i * 7 % 900 for wave in range(3) for i in range(900) if i % 30 // 10 == wave]
    assert [int(m.key) for m in messages] == table_order
