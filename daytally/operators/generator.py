"""Seeded synthetic sales records, made in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.picks import pick, weighted_pick
from daytally.functions.pricing import profit, revenue
from daytally.operators.places import geocode
from daytally.schemas import MESSAGE_FIELDS

# The month, the size of a day, quantities, discounts and their weights.
FIRST_DAY = "2023-12-01"
DAYS = 31
MAX_PER_DAY = 30
MAX_QUANTITY = 20
DISCOUNTS = [(0.5, 10), (0.4, 3), (0.3, 4), (0.0, 12)]

SECONDS_PER_DAY = 86400

# Tries one task makes; the number of tasks follows from it.
TRIES_PER_TASK = 5_000_000


def tries(
    spark: SparkSession,
    seed: int,
    first_day: str = FIRST_DAY,
    days: int = DAYS,
    max_per_day: int = MAX_PER_DAY,
) -> DataFrame:
    """``(day, n)`` for every record to make: 1 to ``max_per_day`` a day, uniform.

    All possible tries are one range of numbers, which Spark splits evenly over tasks
    without a shuffle; those beyond the size of their day are left out. However long a
    day, it is the work of many tasks.
    """
    total = days * max_per_day
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TRIES_PER_TASK))
    place = F.expr(f"id div {max_per_day}").cast("int")
    numbered = spark.range(0, total, 1, tasks).select(
        F.date_add(F.lit(first_day).cast("date"), place).alias("day"), (F.col("id") % max_per_day).alias("n")
    )
    return numbered.filter(F.col("n") < 1 + pick(max_per_day, seed, "size", F.col("day")))


def synthesize(
    wanted: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    gazetteer: DataFrame,
    seed: int,
) -> DataFrame:
    """Full records for ``wanted`` (day, n).

    ``customers`` and ``products`` are indexed dimensions; give them as written tables,
    as their length is looked up as well. Picks are uniform over the index, so these
    joins have no hot key. Records of a place not in ``gazetteer`` are dropped.
    """
    day, n = F.col("day"), F.col("n")
    picked = wanted.select(
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("id"), day.cast("string"), n.cast("string"))).alias("ts_id"),
        F.timestamp_add("SECOND", pick(SECONDS_PER_DAY, seed, "second", day, n).cast("int"), day.cast("timestamp_ntz"))
        .alias("ts"),
        day.alias("ts_date"),
        pick(size_of(customers), seed, "customer", day, n).alias("customer_idx"),
        pick(size_of(products), seed, "product", day, n).alias("product_idx"),
        (1 + pick(MAX_QUANTITY, seed, "quantity", day, n)).cast("int").alias("quantity"),
        weighted_pick([(F.lit(d), w) for d, w in DISCOUNTS], seed, "discount", day, n).alias("discount"),
    )
    joined = picked.join(customers.withColumnRenamed("idx", "customer_idx"), "customer_idx").join(
        products.withColumnRenamed("idx", "product_idx"), "product_idx"
    )
    priced = joined.withColumns(
        {
            "revenue": revenue(F.col("price"), F.col("quantity")),
            "profit": profit(F.col("price"), F.col("quantity"), F.col("discount")),
        }
    )
    return geocode(priced, gazetteer).select(*MESSAGE_FIELDS)


def size_of(indexed: DataFrame) -> Column:
    """The number of rows as a scalar subquery, without a join."""
    return indexed.select(F.count(F.lit(1))).scalar()
