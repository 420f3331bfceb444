import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from daytally.operators.reports import DAILY_ADDRESS, DAILY_PU_REV, REPORTS
from daytally.plans import registry
from daytally.schemas import MESSAGE_FIELDS, SAMPLE_CSV, nullable
from daytally.session import new_folder, settings, shared_root
from daytally.sources import files, stores, topics
from daytally.sources.tables import BATCH_FIELDS, daily_records, event_messages, table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return plan(df).count("FileScan")


@pytest.mark.parametrize(
    "columns, tables",
    [
        (["ts_date", "revenue"], 1),
        (["ts_date", "customer_id"], 2),
        (["category", "quantity"], 2),
        (["customer_id", "segment"], 3),
        (["city"], 5),
        (list(BATCH_FIELDS), 6),
    ],
)
def test_only_needed_tables_are_read(spark, sf_dir, columns, tables):
    rows = daily_records(spark, sf_dir, columns)
    assert rows.columns == columns
    assert scans(rows) == tables


def test_lookups_do_not_change_the_number_of_records(spark, sf_dir):
    rows = daily_records(spark, sf_dir)
    assert rows.count() == table(spark, sf_dir, "lineitem").count()
    assert rows.filter("city IS NULL OR category IS NULL OR customer_name IS NULL").isEmpty()


def test_scan_reads_only_needed_columns(spark, sf_dir):
    rows = DAILY_PU_REV.aggregate(daily_records(spark, sf_dir, DAILY_PU_REV.inputs), exact=True)
    text = plan(rows)
    assert "l_shipdate" in text
    for unused in ("l_tax", "l_returnflag", "l_partkey", "o_totalprice"):
        assert unused not in text


def test_the_line_table_is_shuffled_once_for_all_order_fields(spark, sf_dir):
    """The chain order - customer - place is joined to the lines as a whole."""
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(daily_records(spark, sf_dir, ["customer_id", "segment", "country", "revenue"]))
    lines = [i for i, line in enumerate(text.splitlines()) if "Exchange hashpartitioning(l_" in line]
    assert len(lines) == 1


def test_date_filter_reaches_the_scan(spark, sf_dir):
    with settings(spark, {"spark.sql.maxMetadataStringLength": "1000"}):
        text = plan(registry.queries()["revenue_on_date"](spark, sf_dir))
    assert "GreaterThanOrEqual(l_shipdate,1998-06-15" in text
    assert "LessThan(l_shipdate,1998-06-16" in text


def test_event_messages_are_whole(spark, sf_dir):
    messages = event_messages(spark, sf_dir)
    assert messages.count() == table(spark, sf_dir, "events").count()
    row = messages.select(F.json_object_keys("value").alias("k")).first()
    assert row.k == list(MESSAGE_FIELDS)


def test_csv_round_trip_is_typed(spark, root):
    rows = spark.createDataFrame([("c", 'a "quoted", name', "s", "x", "y", "k", "l", "m", 1 / 3, 2, 0.1)], SAMPLE_CSV)
    files.write_csv(rows, f"{root}/csv")
    back = files.read_csv(spark, f"{root}/csv", nullable(SAMPLE_CSV))
    assert back.schema == nullable(SAMPLE_CSV)
    assert back.collect() == rows.collect()


def export_rows(spark, day, n, name):
    return spark.range(n).selectExpr(
        f"concat('{name}', id) AS ts_id", f"TIMESTAMP'{day} 10:00:00' AS ts", f"DATE'{day}' AS ts_date",
        "'c' AS customer_id", "'n' AS customer_name", "'s' AS segment", "'x' AS country", "'y' AS city",
        "'k' AS category", "'l' AS sub_category", "'m' AS product_name", "1.0D AS price", "2 AS quantity",
        "0.5D AS discount", "2.0D AS revenue", "1.0D AS profit", "1.0D AS latitude", "1.0D AS longitude",
    )


def test_export_replaces_only_its_days(spark, root):
    files.export_daily(export_rows(spark, "2023-12-01", 3, "a").union(export_rows(spark, "2023-12-02", 4, "a")), root)
    files.export_daily(export_rows(spark, "2023-12-02", 9, "b"), root)
    back = spark.read.parquet(root)
    assert {str(r.day): r["count"] for r in back.groupBy("day").count().collect()} == {"2023-12-01": 3, "2023-12-02": 9}
    assert dict(back.dtypes)["ts"] == "string"
    assert dict(back.dtypes)["discount"] == "string"
    names = [n for _, _, found in os.walk(root) for n in found if n.endswith(".parquet")]
    assert names and all(n.endswith(".gz.parquet") for n in names)


def test_export_cuts_a_big_day_into_files(spark, root):
    """A day too big for one task must not be written by one."""
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}):
        files.export_daily(export_rows(spark, "2023-12-01", 60_000, "a").repartition(8), root)
    assert len([n for n in os.listdir(f"{root}/day=2023-12-01") if n.endswith(".parquet")]) > 1


# Connectors: options only, no server is needed or reached


def test_topic_source_options():
    assert topics.source_options("host:1", "daily_records", max_offsets=5) == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "daily_records",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "5",
    }
    assert topics.sink_options("host:1", "daily_address") == {"kafka.bootstrap.servers": "host:1", "topic": "daily_address"}


def test_topic_source_may_fail_on_lost_messages():
    assert topics.source_options("host:1", "t", fail_on_data_loss=True)["failOnDataLoss"] == "true"


def test_topic_source_without_the_connector_fails_at_once(spark):
    with pytest.raises(PySparkException):
        topics.read_topic(spark, "host:1", "daily_records")


def test_store_options_and_upsert():
    assert stores.keyed_store_options("spark_streams", "daily_pu_rev") == {
        "keyspace": "spark_streams",
        "table": "daily_pu_rev",
    }
    assert stores.jdbc_options("jdbc:x", "t", "u", "p")["dbtable"] == "t"
    assert stores.merge_sql(DAILY_ADDRESS, "r.daily_address", "r.new") == (
        "INSERT INTO r.daily_address (ts_date, latitude, longitude, daily_pu, version) "
        "SELECT ts_date, latitude, longitude, daily_pu, version FROM r.new "
        "ON CONFLICT (ts_date, latitude, longitude) DO UPDATE SET daily_pu = EXCLUDED.daily_pu, version = EXCLUDED.version "
        "WHERE r.daily_address.version < EXCLUDED.version"
    )


# Settings


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_reports_are_named_by_their_key():
    assert all(name == report.name for name, report in REPORTS.items())
