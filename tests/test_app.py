import duckdb
import pytest
from pyspark.sql import functions as F

from daytally import app
from daytally.__main__ import parse
from daytally.functions.envelope import good, inspect
from daytally.operators.places import geocode
from daytally.operators.reports import ALL_REPORTS, DAILY_PU_REV
from daytally.plans.registry import queries
from daytally.schemas import SAMPLE_CSV
from daytally.sources import stores
from daytally.sources.files import read_topic_files, topic_messages
from daytally.streaming import jobs
from daytally.streaming.changelog import newest_rows


@pytest.fixture(scope="module")
def deployment(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("deployment"))
    sample = spark.range(200).selectExpr(
        "concat('c', id % 20) AS customer_id", "concat('name ', id % 20) AS customer_name", "'Consumer' AS segment",
        "'US' AS country", "concat('city ', id % 4) AS city", "'Furniture' AS category",
        "concat('sub ', id % 3) AS sub_category", "concat('thing ', id % 11) AS product_name",
        "id + 10.5D AS sales", "cast(1 + id % 5 AS int) AS quantity", "0.2D AS discount",
    )
    assert sample.schema.fieldNames() == SAMPLE_CSV.fieldNames()
    sample.write.option("header", True).csv(f"{root}/sample")
    spark.sql(
        "SELECT 'US' AS country, concat('city ', id) AS city, 40.0 + id AS latitude, -74.0 - id AS longitude "
        "FROM range(3)"
    ).write.option("header", True).csv(f"{root}/places")

    def make(seed):
        app.generate(spark, f"{root}/sample", f"{root}/places", f"{root}/topic", f"{root}/export", seed, 30)

    def run():
        app.stream(spark, f"{root}/topic", f"{root}/out", None, 0, once=True)
        app.tables(spark, f"{root}/out", 0, once=True)

    make(1)
    run()
    make(2)
    run()
    return root


def total(spark, root):
    sql = "SELECT SUM(daily_rev) FROM daily_report.daily_category_product WHERE ts_date = '2023-12-01'"
    return app.query(spark, f"{root}/out", sql).first()[0]


def test_reports_equal_the_messages(spark, deployment):
    records = good(inspect(topic_messages(spark, f"{deployment}/topic")))
    want = records.filter("ts_date = '2023-12-01'").agg(F.sum("revenue")).first()[0]
    assert want > 0
    assert total(spark, deployment) == pytest.approx(want)
    app.compact_all(spark, f"{deployment}/out")
    assert total(spark, deployment) == pytest.approx(want)
    days = app.query(spark, f"{deployment}/out", "SELECT count(*) FROM daily_report.daily_pu_rev").first()[0]
    assert days == records.select("ts_date").distinct().count()


def test_a_sending_is_tried_again_safely_and_keeps_keys(spark, deployment):
    before = topic_messages(spark, f"{deployment}/topic")
    n = before.count()
    app.generate(spark, f"{deployment}/sample", f"{deployment}/places", f"{deployment}/topic", f"{deployment}/export", 2, 30)
    after = topic_messages(spark, f"{deployment}/topic")
    assert after.count() == n == after.select("offset").distinct().count()
    assert after.filter("key IS NULL OR key <> get_json_object(value, '$.ts_id')").isEmpty()


def test_final_days_by_command(spark, deployment, root):
    app.final(spark, f"{deployment}/topic", root, None, "1 day", once=True)
    assert spark.read.parquet(f"{root}/final_days").count() > 0
    assert parse(["final", "--topic", "t", "--root", "r"]).delay == "1 day"


def test_raw_records_by_sql(spark, deployment):
    n = app.query(spark, f"{deployment}/out", "SELECT count(*) FROM daily_report.daily_records").first()[0]
    assert n == jobs.read_raw(spark, f"{deployment}/out").select("ts_id").distinct().count() > 0


def test_settings_come_back(spark, sf_dir):
    keys = ("spark.sql.session.timeZone", "spark.sql.streaming.stateStore.providerClass")
    before = [spark.conf.get(k, None) for k in keys]
    databases = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    queries()["typed_reports"](spark, sf_dir).count()
    assert [spark.conf.get(k, None) for k in keys] == before
    assert {r[0] for r in spark.sql("SHOW DATABASES").collect()} == databases


def test_a_second_run_adds_to_the_topic_and_replaces_the_export(spark, deployment):
    messages = topic_messages(spark, f"{deployment}/topic").count()
    exported = spark.read.parquet(f"{deployment}/export").count()
    assert exported < messages
    assert jobs.read_raw(spark, f"{deployment}/out").count() == messages


def test_records_of_unknown_places_are_not_sent(spark, deployment):
    records = good(inspect(topic_messages(spark, f"{deployment}/topic")))
    assert {r.city for r in records.select("city").distinct().collect()} == {"city 0", "city 1", "city 2"}


def test_reports_are_upserted_into_a_database_by_command(spark, deployment, monkeypatch):
    """The statements run in an embedded database in place of a served one."""
    database = duckdb.connect()

    def stage(rows, url, staging, user, password):
        assert (url, user, password) == ("jdbc:x", "me", "secret")
        database.register("sent", rows.toArrow())
        database.execute(f"CREATE OR REPLACE TABLE {staging} AS SELECT * FROM sent")

    monkeypatch.setenv("DATABASE_SECRET", "secret")
    monkeypatch.setattr(stores, "stage_report", stage)
    monkeypatch.setattr(stores, "statement_runner", lambda *_: database.execute)
    args = vars(parse(["tables", "--root", f"{deployment}/out", "--once", "--fill", "--database", "jdbc:x", "--user", "me", "--password-variable", "DATABASE_SECRET", "--table-prefix", "r_"]))
    assert args.pop("command") == "tables"
    for _ in range(2):  # a second time changes nothing
        app.tables(spark, **args)
        for name, report in ALL_REPORTS.items():
            want = newest_rows(spark, report, f"{deployment}/out/{name}").toArrow().to_pylist()
            got = database.sql(f"SELECT * FROM r_{name}").to_arrow_table().to_pylist()
            assert sorted(map(str, got)) == sorted(map(str, want)) and got

    sink = app.database_sinks(spark, "jdbc:x", "me", "secret", "r_")["daily_pu_rev"]
    rows = newest_rows(spark, DAILY_PU_REV, f"{deployment}/out/daily_pu_rev")
    one = rows.filter("ts_date = '2023-12-01'").withColumn("daily_rev", F.lit(-1).cast(rows.schema["daily_rev"].dataType))
    read = lambda: database.execute("SELECT daily_rev, version FROM r_daily_pu_rev WHERE ts_date = '2023-12-01'").fetchall()[0]
    before = read()
    sink(one.withColumn("version", F.col("version") - 1))
    assert read() == before
    sink(one.withColumn("version", F.col("version") + 1))
    assert read() == (-1, before[1] + 1)


def test_a_stream_can_be_geocoded(spark, deployment, root):
    """The lookup is a static table; on a stream its keys are salted."""
    places = spark.read.option("header", True).csv(f"{deployment}/places").filter("city <> 'city 1'")

    def located(messages):
        return geocode(good(inspect(messages)).drop("latitude", "longitude"), places)

    rows = located(read_topic_files(spark, f"{deployment}/topic")).select("ts_id", "latitude", "longitude")
    assert "_salt" in rows._jdf.queryExecution().analyzed().toString()
    query = (
        rows.writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    jobs.finish([query])
    want = located(topic_messages(spark, f"{deployment}/topic")).select("ts_id", "latitude", "longitude")
    got = spark.read.parquet(f"{root}/out")
    assert got.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_exact_users_cannot_stream(spark, deployment):
    """Why the stream keeps the estimate."""
    records = good(inspect(read_topic_files(spark, f"{deployment}/topic")))
    with pytest.raises(Exception, match="(?i)distinct"):
        DAILY_PU_REV.aggregate(records, exact=True).writeStream.format("noop").outputMode("update").start()


def test_command_line():
    args = parse(["stream", "--topic", "t", "--root", "r", "--once"])
    assert (args.command, args.topic, args.servers, args.run, args.once) == ("stream", "t", None, 0, True)
    assert not args.fail_on_data_loss and parse(["final", "--topic", "t", "--root", "r", "--fail-on-data-loss"]).fail_on_data_loss
    assert parse(["query", "SELECT 1", "--root", "r"]).sql == "SELECT 1"
    assert parse(["generate", "--sample", "s", "--places", "p", "--topic", "t", "--export", "e"]).max_per_day == 30


def test_every_query_is_registered_by_a_plain_name():
    assert all(name.islower() and name.isidentifier() for name in queries())
