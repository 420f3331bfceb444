import pytest
from pyspark.sql import functions as F

from daytally.operators import generator
from daytally.operators.dimensions import (
    customer_dim,
    indexed_customers,
    indexed_products,
    product_dim,
)
from daytally.operators.latest import latest_by, latest_records, latest_rows, version_of
from daytally.operators.places import geocode
from daytally.operators.reports import (
    DAILY_ADDRESS,
    DAILY_CATEGORY_PRODUCT,
    DAILY_PU_REV,
    roll_up,
    users_with_bound,
)
from daytally.schemas import SAMPLE_CSV


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SALES = "ts_date string, customer_id string, category string, sub_category string, product_name string, " \
    "quantity int, revenue float, profit float, latitude string, longitude string"


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        ("2023-12-01", "a", "c", "s", "p", 1, 10.0, 9.0, "1.0", "2.0"),
        ("2023-12-01", "a", "c", "s", "p", 2, 20.0, 18.0, "1.0", "2.0"),
        ("2023-12-01", "b", "c", "s", "q", 3, 30.0, 27.0, "1.0", "3.0"),
        ("2023-12-02", "b", "c", "s", "q", 4, 40.0, 36.0, "1.0", "3.0"),
    ]
    return spark.createDataFrame(rows, SALES)


@pytest.mark.parametrize("exact", [True, False])
def test_daily_pu_rev(sales, exact):
    assert bag(DAILY_PU_REV.aggregate(sales, exact)) == [("2023-12-01", 2, 60.0, 54.0), ("2023-12-02", 1, 40.0, 36.0)]


def test_daily_category_product(sales):
    assert bag(DAILY_CATEGORY_PRODUCT.aggregate(sales)) == [
        ("2023-12-01", "c", "s", "p", 3, 30.0, 27.0),
        ("2023-12-01", "c", "s", "q", 3, 30.0, 27.0),
        ("2023-12-02", "c", "s", "q", 4, 40.0, 36.0),
    ]


@pytest.mark.parametrize("exact", [True, False])
def test_daily_address(sales, exact):
    assert bag(DAILY_ADDRESS.aggregate(sales, exact)) == [
        ("2023-12-01", "1.0", "2.0", 1),
        ("2023-12-01", "1.0", "3.0", 1),
        ("2023-12-02", "1.0", "3.0", 1),
    ]


def test_aggregate_types(sales):
    types = dict(DAILY_CATEGORY_PRODUCT.aggregate(sales).dtypes)
    assert types["daily_quantity"] == "bigint"
    assert types["daily_rev"] == "double"


def test_a_repeated_record_counts_twice(sales):
    once = DAILY_PU_REV.aggregate(sales).agg(F.sum("daily_rev")).first()[0]
    twice = DAILY_PU_REV.aggregate(sales.union(sales)).agg(F.sum("daily_rev")).first()[0]
    assert twice == 2 * once


def test_sum_widens_floats(spark):
    rows = spark.range(3).select(F.lit("2023-12-01").alias("ts_date"), F.lit(0.1).cast("float").alias("revenue"))
    total = rows.groupBy("ts_date").agg(F.sum("revenue").alias("t")).first().t
    assert total != pytest.approx(0.3, abs=1e-10)
    assert total == pytest.approx(0.3, abs=1e-6)


def test_roll_up_equals_the_day(sales):
    rolled = roll_up(DAILY_CATEGORY_PRODUCT.aggregate(sales), "ts_date", "daily_rev", "rev")
    assert bag(rolled) == bag(DAILY_PU_REV.aggregate(sales).select("ts_date", "daily_rev"))


def test_sum_over_a_day_without_rows_is_one_null(sales):
    day = DAILY_CATEGORY_PRODUCT.aggregate(sales).filter("ts_date = '1990-01-01'")
    assert bag(day.agg(F.sum("daily_rev"))) == [(None,)]


def test_estimate_equals_direct_estimate(spark):
    """Estimating from distinct pairs gives the number that estimating from rows gives."""
    rows = spark.range(40_000).selectExpr("id % 3 AS ts_date", "cast(pmod(hash(id), 5000) as string) AS customer_id")
    direct = rows.groupBy("ts_date").agg(F.approx_count_distinct("customer_id", 0.05).alias("n"))
    pairs = rows.distinct().groupBy("ts_date").agg(F.approx_count_distinct("customer_id", 0.05).alias("n"))
    assert bag(direct) == bag(pairs)
    assert all(r.pu_in_bound for r in users_with_bound(rows, ["ts_date"]).collect())


# Latest per key


def test_latest_rows_in_any_order(spark):
    rows = [("2023-12-01", 2, 2.0, 2.0, 2), ("2023-12-01", 1, 1.0, 1.0, 1), ("2023-12-01", 3, 3.0, None, 3)]
    changes = spark.createDataFrame(
        rows, "ts_date string, daily_pu bigint, daily_rev double, daily_profit double, version bigint"
    )
    want = [("2023-12-01", 3, 3.0, None)]
    assert bag(latest_rows(DAILY_PU_REV, changes)) == want
    assert bag(latest_rows(DAILY_PU_REV, changes.union(changes))) == want
    assert bag(latest_rows(DAILY_PU_REV, changes.orderBy("version"))) == want


def test_latest_rows_hashes(spark):
    """Numeric totals keep fixed-width buffers: no sort of all versions."""
    schema = "ts_date date, daily_pu bigint, daily_rev double, daily_profit double, version bigint"
    plan = latest_rows(DAILY_PU_REV, spark.createDataFrame([], schema))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_latest_rows_of_merged_keys_is_repeatable(spark):
    """Two texts that are one number meet in one version: the result must not vary."""
    rows = [("2023-12-01", 40.0, 1.0, n, 5) for n in (3, 9, 4)]
    schema = "ts_date string, latitude double, longitude double, daily_pu bigint, version bigint"
    for order in (rows, rows[::-1]):
        assert bag(latest_rows(DAILY_ADDRESS, spark.createDataFrame(order, schema))) == [("2023-12-01", 40.0, 1.0, 9)]


def test_versions_of_a_later_run_are_higher():
    assert version_of(1, 0) > version_of(0, 10**9)


def test_latest_by_breaks_ties_by_value(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "n")], "k int, o int, v string")
    assert bag(latest_by(rows, ["k"], ["o"])) == [(1, 5, "b"), (2, None, "n")]


def test_latest_records_filter_prunes_by_day(spark, root):
    rows = spark.sql(
        "SELECT 'a' AS ts_id, DATE'2023-12-01' AS ts_date, 1.0 AS revenue, 1L AS offset, TIMESTAMP'2024-01-02' AS arrived_at "
        "UNION ALL SELECT 'a', DATE'2023-12-01', 2.0, 2L, TIMESTAMP'2024-01-01' "
        "UNION ALL SELECT 'b', DATE'2023-12-02', 3.0, 3L, TIMESTAMP'2024-01-01'"
    )
    rows.write.partitionBy("ts_date").parquet(f"{root}/raw")
    raw = spark.read.parquet(f"{root}/raw")
    assert bag(latest_records(raw).select("ts_id", "revenue")) == bag(
        spark.sql("SELECT 'a', 2.0 UNION ALL SELECT 'b', 3.0")
    )
    day = latest_records(raw, resent_same_day=True).filter("ts_date = DATE'2023-12-01'")
    assert day.count() == 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ts_date" in plan


# Dimensions


def sample(spark):
    rows = [
        ("c1", "Ann", "s", "US", "NYC", "k", "l", "m", 100.0, 2, 0.5),
        ("c1", "Ann", "s", "US", "NYC", "k", "l", "m", 50.0, 1, 0.5),
        ("c2", "Bob", "s", "US", "LA", "k", "l", "m", 90.0, 3, 0.0),
        ("c2", "Bob", "s", "US", "LA", "k", "l", "n", 90.0, 0, 0.0),
    ]
    return spark.createDataFrame(rows, SAMPLE_CSV)


def test_dimensions(spark):
    assert customer_dim(sample(spark)).count() == 2
    assert bag(product_dim(sample(spark))) == [("k", "l", "m", 100.0), ("k", "l", "m", 30.0), ("k", "l", "n", None)]


@pytest.mark.parametrize("n", [0, 1, 20_000])
def test_index_is_dense_and_repeatable(spark, n):
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("customer_id"),
        *[F.lit("x").alias(c) for c in ("customer_name", "segment", "country", "city")],
    )
    indexed = indexed_customers(rows)
    summary = indexed.agg(F.count("idx"), F.count_distinct("idx"), F.min("idx"), F.max("idx")).first()
    assert tuple(summary) == ((n, n, 0, n - 1) if n else (0, 0, None, None))
    assert indexed_customers(rows.repartition(5)).exceptAll(indexed).isEmpty()


def test_index_of_one_product_with_many_prices_spreads(spark):
    rows = spark.range(20_000).selectExpr(
        "'k' AS category", "'l' AS sub_category", "'m' AS product_name", "id / 100 AS price"
    )
    from daytally.operators.dimensions import bucket_of

    millionths = F.floor(F.col("price") * 1_000_000).cast("bigint").cast("string")
    largest = rows.groupBy(bucket_of("category", "sub_category", "product_name", millionths)).count()
    assert largest.agg(F.max("count")).first()[0] < 50
    assert indexed_products(rows).agg(F.max("idx")).first()[0] == 19_999


# Lookup


def facts(spark, n=9000):
    """A third of all facts is of one city; some cities are unknown."""
    return spark.range(n).selectExpr(
        "cast(id as string) AS ts_id",
        "'US' AS country",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('c', id % 50) ELSE 'nowhere' END AS city",
    )


def gazetteer(spark):
    return spark.range(50).selectExpr(
        "'US' AS country", "concat('c', id) AS city", "id * 1.0D AS latitude", "id * 2.0D AS longitude"
    ).unionAll(spark.sql("SELECT 'US', 'hot', 7.0D, 8.0D"))


def test_geocode_drops_unknown_places(spark):
    rows = geocode(facts(spark), gazetteer(spark))
    assert rows.count() == 6000
    assert rows.filter("city = 'hot'").select("latitude", "longitude").distinct().collect() == [(7.0, 8.0)]


def test_place_with_two_locations_does_not_multiply_records(spark):
    twice = gazetteer(spark).unionAll(spark.sql("SELECT 'US', 'hot', 1.0D, 9.0D"))
    rows = geocode(facts(spark), twice)
    assert rows.count() == 6000
    assert rows.filter("city = 'hot'").select("latitude", "longitude").distinct().collect() == [(1.0, 9.0)]


# Generator


def test_tries_spread_over_tasks(spark, monkeypatch):
    """A long day is split over tasks, and none of its records is lost or repeated."""
    whole = generator.tries(spark, 5, days=3, max_per_day=5000)
    want = bag(whole)
    monkeypatch.setattr(generator, "TRIES_PER_TASK", 700)
    split = generator.tries(spark, 5, days=3, max_per_day=5000)
    assert bag(split) == want
    assert len(set(want)) == len(want)
    assert split.select(F.spark_partition_id()).distinct().count() > 10
    assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()
    for day in {d for d, _ in want}:
        numbers = [n for d, n in want if d == day]
        assert sorted(numbers) == list(range(len(numbers)))


def test_tries_per_day_in_range(spark):
    sizes = generator.tries(spark, 11).groupBy("day").count().collect()
    assert len(sizes) == 31
    assert all(1 <= r["count"] <= 30 for r in sizes)
    assert len({r["count"] for r in sizes}) > 5


def test_synthetic_records(spark):
    people = spark.range(40).selectExpr(
        "id AS idx", "cast(id as string) AS customer_id", "'n' AS customer_name", "'s' AS segment",
        "'US' AS country", "concat('c', id % 60) AS city",
    )
    goods = spark.range(7).selectExpr(
        "id AS idx", "'k' AS category", "'l' AS sub_category", "concat('m', id) AS product_name", "id + 1.5D AS price"
    )
    places = gazetteer(spark).filter("city <> 'c3'")
    wanted = generator.tries(spark, 3, max_per_day=400)
    rows = generator.synthesize(wanted, people, goods, places, 3).cache()
    assert 0 < rows.count() < wanted.count()
    assert rows.select("ts_id").distinct().count() == rows.count()
    assert rows.filter("city = 'c3'").isEmpty()
    assert rows.filter("to_date(ts) <> ts_date OR quantity NOT BETWEEN 1 AND 20").isEmpty()
    assert rows.filter("revenue <> price * quantity OR profit <> price * quantity * (1 - discount)").isEmpty()
    assert {r.customer_id for r in rows.select("customer_id").distinct().collect()} == {
        str(i) for i in range(40) if i != 3
    }
    shares = {r.discount: r["count"] / rows.count() for r in rows.groupBy("discount").count().collect()}
    for value, weight in generator.DISCOUNTS:
        assert shares[value] == pytest.approx(weight / 29, abs=0.04)
    again = generator.synthesize(wanted.repartition(3), people, goods, places, 3)
    assert again.exceptAll(rows).isEmpty()
