import datetime

import pytest
from pyspark.sql import functions as F

from daytally.functions.envelope import REASON, bad, decode, encode, encode_records, good, inspect
from daytally.functions.picks import pick, weighted_pick
from daytally.functions.pricing import list_price, profit, revenue
from daytally.schemas import MESSAGE_FIELDS, RECORD

WHOLE = (
    '{"ts_id":"a","ts":"2023-12-01 10:00:00","ts_date":"2023-12-01","customer_id":"c","customer_name":"n",'
    '"segment":"s","country":"x","city":"y","category":"k","sub_category":"l","product_name":"m",'
    '"price":261.95999999,"quantity":3,"discount":"0.5","revenue":785.88,"profit":392.94,'
    '"latitude":40.7127281,"longitude":-74.0}'
)


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_decode_whole_record(spark):
    row = decode(messages(spark, WHOLE), RECORD).first()
    assert row.ts == datetime.datetime(2023, 12, 1, 10)
    assert row.ts_date == datetime.date(2023, 12, 1)
    assert round(row.price, 4) == 261.96
    assert (row.latitude, row.longitude) == ("40.7127281", "-74.0")
    assert "discount" not in row.asDict()


def test_decode_takes_bytes(spark):
    rows = messages(spark, WHOLE).select(F.col("value").cast("binary").alias("value"))
    assert decode(rows, RECORD).first().ts_id == "a"
    assert good(inspect(rows)).count() == 1


def test_small_coordinate_as_text(spark):
    text = WHOLE.replace("40.7127281", "1e-5")
    assert decode(messages(spark, text), RECORD).first().latitude == "1.0E-5"


@pytest.mark.parametrize(
    "value, reason",
    [
        (WHOLE, None),
        (None, "empty"),
        ("", "empty"),
        ("  ", "empty"),
        ("not json", "malformed"),
        ("null", "malformed"),
        (WHOLE.replace("2023-12-01 10:00:00", "bad"), "malformed"),
        (WHOLE.replace('"ts_date":"2023-12-01"', '"ts_date":"2023-13-45"'), "malformed"),
        (WHOLE.replace("261.95999999", '"x"'), "malformed"),
        (WHOLE.replace('"quantity":3', '"quantity":3.5'), "malformed"),
        (WHOLE.replace('"ts_id":"a",', ""), "incomplete"),
        ('{"ts_id":"b"}', "incomplete"),
    ],
)
def test_quarantine_reason(spark, value, reason):
    row = inspect(messages(spark, value)).first()
    assert row[REASON] == reason


def test_quarantine_keeps_the_whole_text(spark):
    long = "x" * 50_000
    rows = inspect(messages(spark, WHOLE, long))
    assert good(rows).columns == RECORD.fieldNames()
    assert good(rows).count() == 1
    assert [tuple(r) for r in bad(rows).collect()] == [("malformed", long)]


def test_json_is_parsed_once(spark):
    """A filter on the reason must not be moved below the parse."""
    plan = good(inspect(messages(spark, WHOLE)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_leaves_nulls_out(spark):
    rows = spark.createDataFrame([(1, None, 7)], "a int, b string, version bigint")
    row = encode(rows, "version").first()
    assert (row.value, row.version) == ('{"a":1}', 7)


def test_encode_records_form(spark):
    rows = spark.sql(
        "SELECT *, 0.5D AS discount FROM VALUES ('a', TIMESTAMP'2023-12-01 10:00:00.5', DATE'2023-12-01', 'c', 'n',"
        " 's', 'x', 'y', 'k', 'l', 'm', 2.0D, 3, 6.0D, 3.0D, 1.5D, 2.5D) AS "
        "t(ts_id, ts, ts_date, customer_id, customer_name, segment, country, city, category, sub_category, "
        "product_name, price, quantity, revenue, profit, latitude, longitude)"
    )
    row = encode_records(rows).first()
    assert row.key == "a"
    assert '"ts":"2023-12-01 10:00:00","ts_date":"2023-12-01"' in row.value
    assert '"discount":"0.5","revenue":6.0' in row.value
    assert [p.split('"')[1] for p in row.value[1:-1].split(",")] == list(MESSAGE_FIELDS)


def test_list_price_of_zero_quantity_or_full_discount(spark):
    rows = spark.createDataFrame([(100.0, 4, 0.5), (100.0, 0, 0.5), (100.0, 4, 1.0)], "s double, q int, d double")
    assert [r[0] for r in rows.select(list_price(F.col("s"), F.col("q"), F.col("d"))).collect()] == [50.0, None, None]


def test_revenue_is_before_and_profit_after_discount(spark):
    rows = spark.createDataFrame([(10.0, 3, 0.4)], "p double, q int, d double")
    row = rows.select(
        revenue(F.col("p"), F.col("q")).alias("r"), profit(F.col("p"), F.col("q"), F.col("d")).alias("f")
    ).first()
    assert (row.r, row.f) == (30.0, 18.0)


def test_picks_are_uniform_and_repeatable(spark):
    rows = spark.range(29_000).select(
        pick(10, 1, "a", F.col("id")).alias("ten"),
        pick(10, 2, "a", F.col("id")).alias("other_seed"),
        weighted_pick([(F.lit("x"), 1), (F.lit("y"), 28)], 1, "w", F.col("id")).alias("w"),
    )
    tens = {r.ten: r["count"] for r in rows.groupBy("ten").count().collect()}
    assert set(tens) == set(range(10))
    assert all(abs(n - 2900) < 300 for n in tens.values())
    assert 800 < rows.filter("w = 'x'").count() < 1200
    assert rows.filter("ten != other_seed").count() > 25_000
    assert rows.repartition(7).exceptAll(rows).isEmpty()
