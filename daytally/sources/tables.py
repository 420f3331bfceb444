"""Sales records from the star-schema tables, and messages from the event table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.envelope import TS_FORMAT
from daytally.functions.pricing import list_price, profit, revenue
from daytally.schemas import MESSAGE_FIELDS, SAMPLE_CSV
from daytally.session import new_folder
from daytally.sources.files import POSITION

_CUSTOMER_SIDE = {"customer_name", "segment", "country", "city"}
_PLACE = {"country", "city"}
_PART_SIDE = {"category": "p_type", "sub_category": "p_brand", "product_name": "p_name"}

BATCH_FIELDS = (
    "ts_id",
    "ts",
    "ts_date",
    "customer_id",
    "customer_name",
    "segment",
    "country",
    "city",
    "category",
    "sub_category",
    "product_name",
    "price",
    "quantity",
    "discount",
    "revenue",
    "profit",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_date() -> Column:
    return F.to_date("l_shipdate")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        "n_nationkey", F.col("r_name").alias("country"), F.col("n_name").alias("city")
    )


def customers(spark: SparkSession, sf_dir: str, columns: Iterable[str]) -> DataFrame:
    """Customers with the named fields; places are looked up only if asked for."""
    wanted = set(columns)
    rows = table(spark, sf_dir, "customer")
    if wanted & _PLACE:
        places = nations(spark, sf_dir)
        rows = rows.join(places, rows.c_nationkey == places.n_nationkey, "left")
    named = {
        "customer_id": F.col("c_custkey").cast("string"),
        "customer_name": F.col("c_name"),
        "segment": F.col("c_mktsegment"),
        "country": F.col("country") if wanted & _PLACE else None,
        "city": F.col("city") if wanted & _PLACE else None,
    }
    fields = [expr.alias(name) for name, expr in named.items() if name in wanted]
    return rows.select("c_custkey", *fields)


def _orders(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    """One row per order with everything known about its customer.

    The customer is joined here, to the orders, and not to the much longer list of
    lines, which then needs only one shuffle for all order-side fields.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    buyer = wanted & _CUSTOMER_SIDE
    if buyer:
        who = customers(spark, sf_dir, buyer)
        orders = orders.join(who, orders.o_custkey == who.c_custkey, "left")
    customer_id = [F.col("o_custkey").cast("string").alias("customer_id")] if "customer_id" in wanted else []
    return orders.select("o_orderkey", *customer_id, *sorted(buyer))


def daily_records(spark: SparkSession, sf_dir: str, columns: Iterable[str] = BATCH_FIELDS) -> DataFrame:
    """One sales record per order line, with the named columns.

    Order, customer, place and product are found by key and never change the number
    of records, so a table none of whose fields is asked for is not read at all. No
    join carries a hint: Spark broadcasts a side whose size allows it, at planning or
    at run time, and otherwise shuffles both sides and splits hot keys.
    """
    columns = list(columns)
    wanted = set(columns)
    rows = table(spark, sf_dir, "lineitem")
    if wanted & (_CUSTOMER_SIDE | {"customer_id"}):
        orders = _orders(spark, sf_dir, wanted)
        rows = rows.join(orders, rows.l_orderkey == orders.o_orderkey, "left")
    if wanted & _PART_SIDE.keys():
        part = table(spark, sf_dir, "part")
        part = part.select("p_partkey", *[F.col(c).alias(n) for n, c in _PART_SIDE.items() if n in wanted])
        rows = rows.join(part, rows.l_partkey == part.p_partkey, "left")
    price = list_price(F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_discount"))
    quantity = F.col("l_quantity").cast("int")
    derived = {
        "ts_id": line_id(),
        "ts": F.col("l_shipdate").cast("timestamp"),
        "ts_date": line_date(),
        "sales": F.col("l_extendedprice"),
        "price": price,
        "quantity": quantity,
        "discount": F.col("l_discount"),
        "revenue": revenue(price, quantity),
        "profit": profit(price, quantity, F.col("l_discount")),
        "version": F.col("l_linenumber"),
    }
    return rows.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in columns])


def line_id() -> Column:
    return F.concat_ws(
        "-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    )


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A location for each nation, standing in for cities."""
    key = F.col("n_nationkey")
    return nations(spark, sf_dir).select(
        "country",
        "city",
        (key * 5 - 60).cast("double").alias("latitude"),
        (key * 13 - 160).cast("double").alias("longitude"),
    )


def sample_sales(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] = tuple(SAMPLE_CSV.fieldNames())
) -> DataFrame:
    """The sales sample from which both dimensions are taken: each sale as sold."""
    return daily_records(spark, sf_dir, columns)


def even_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table in even files, with each row's place in the table.

    A row group is read by one task, and the table may be a single one. What sends it or
    reads it several times takes this copy, so that as many tasks work as there are cores.
    """
    path = new_folder(spark, "events")
    placed = table(spark, sf_dir, "events").withColumn(POSITION, F.monotonically_increasing_id())
    placed.repartition(POSITION).write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def event_records(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """The event table as sales records, with times in whole seconds as sent; of ``events``,
    if given (see :func:`even_events`), with their places."""
    rows = table(spark, sf_dir, "events") if events is None else events
    user, spot = F.col("user_id"), F.col("user_id") % 25
    k = F.get_json_object("props", "$.k").cast("int")
    discount = F.lit(0.1)
    named = {
        "ts_id": F.col("event_id").cast("string"),
        "ts": F.date_format("ts", TS_FORMAT),
        "ts_date": F.date_format("ts", "yyyy-MM-dd"),
        "customer_id": user.cast("string"),
        "customer_name": F.concat(F.lit("User#"), user.cast("string")),
        "segment": F.concat(F.lit("S"), (user % 3).cast("string")),
        "country": F.concat(F.lit("C"), (spot % 5).cast("string")),
        "city": F.concat(F.lit("T"), spot.cast("string")),
        "category": F.col("event_type"),
        "sub_category": F.concat(F.lit("k"), (k % 5).cast("string")),
        "product_name": F.concat(F.lit("p"), k.cast("string")),
        "price": F.col("value"),
        "quantity": k,
        "discount": discount.cast("string"),
        "revenue": F.col("value"),
        "profit": F.col("value") * (F.lit(1) - discount),
        "latitude": (spot * 5 - 60).cast("double"),
        "longitude": (spot * 13 - 160).cast("double"),
    }
    return rows.select(*[named[c].alias(c) for c in MESSAGE_FIELDS], *place_of(rows))


def to_messages(records: DataFrame) -> DataFrame:
    """One keyed JSON message per record, with its ``ts_date`` beside it to split the feed by,
    and its place if it has one."""
    value = F.to_json(F.struct(*MESSAGE_FIELDS))
    return records.select(F.col("ts_id").alias("key"), value.alias("value"), "ts_date", *place_of(records))


def place_of(rows: DataFrame) -> list[str]:
    return [POSITION] if POSITION in rows.columns else []


def event_messages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    return to_messages(event_records(spark, sf_dir, events))
