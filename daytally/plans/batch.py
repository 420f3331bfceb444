"""Batch queries. Each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.envelope import REASON, decode, encode_records, good, inspect
from daytally.functions.pricing import list_price
from daytally.operators import dimensions, generator
from daytally.operators.latest import VERSION, latest_by, latest_rows
from daytally.operators.places import geocode
from daytally.operators.reports import (
    DAILY_ADDRESS,
    DAILY_CATEGORY_PRODUCT,
    DAILY_PU_REV,
    REPORTS,
    Report,
    roll_up,
    users_with_bound,
)
from daytally.schemas import (
    CUSTOMER_FIELDS,
    MESSAGE_FIELDS,
    PRODUCT_SALE_FIELDS,
    RECORD,
    RECORD_FIELDS,
    SAMPLE_CSV,
    nullable,
)
from daytally.session import new_folder, settings
from daytally.sources import files
from daytally.sources.tables import (
    customers,
    daily_records,
    event_messages,
    event_records,
    gazetteer,
    line_id,
    place_of,
    sample_sales,
    table,
)
from daytally.streaming.changelog import (
    compact,
    create_tables,
    read_changelog,
    read_changes,
    to_report_types,
    write_changes,
    write_version,
)

REPORT_DATE = "1998-06-15"
SEED = 2023


def money(name: str) -> Column:
    """Totals to the cent: the order of summation must not show."""
    return F.round(name, 2).alias(name)


def tidy(rows: DataFrame) -> DataFrame:
    return rows.select(*[money(c) if c in ("daily_rev", "daily_profit") else c for c in rows.columns])


def located_records(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Records with their coordinates, found by country and city."""
    plain = [c for c in columns if c not in ("latitude", "longitude")]
    needed = list(dict.fromkeys([*plain, "ts_id", "country", "city"]))
    return geocode(daily_records(spark, sf_dir, needed), gazetteer(spark, sf_dir)).select(*columns)


def report_input(spark: SparkSession, sf_dir: str, report: Report, *more: str) -> DataFrame:
    """The records a report reads, with no other columns than it needs."""
    source = located_records if "latitude" in report.inputs else daily_records
    return source(spark, sf_dir, [*report.inputs, *more])


# Reports


def daily_pu_rev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(DAILY_PU_REV.aggregate(report_input(spark, sf_dir, DAILY_PU_REV), exact=True))


def daily_pu_rev_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_with_bound(daily_records(spark, sf_dir, ["ts_date", "customer_id"]), DAILY_PU_REV.key_names)


def daily_category_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(DAILY_CATEGORY_PRODUCT.aggregate(report_input(spark, sf_dir, DAILY_CATEGORY_PRODUCT)))


def daily_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DAILY_ADDRESS.aggregate(report_input(spark, sf_dir, DAILY_ADDRESS), exact=True)


def daily_address_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_with_bound(report_input(spark, sf_dir, DAILY_ADDRESS), DAILY_ADDRESS.key_names)


def float32_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue narrowed to 32 bits as on the stream, then summed in 64."""
    records = daily_records(spark, sf_dir, ["ts_date", "revenue"])
    narrow = records.select("ts_date", F.col("revenue").cast("float").alias("revenue"))
    return tidy(narrow.groupBy("ts_date").agg(F.sum("revenue").alias("daily_rev")))


def revenue_on_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL on a report; the date reaches the scan through view and aggregate."""
    report = DAILY_CATEGORY_PRODUCT.aggregate(report_input(spark, sf_dir, DAILY_CATEGORY_PRODUCT))
    return spark.sql(
        "SELECT round(sum(daily_rev), 2) AS daily_rev FROM {report} WHERE ts_date = :day",
        args={"day": REPORT_DATE},
        report=report,
    )


def rollup_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's revenue must be the same from the product report as from the records."""
    by_product = DAILY_CATEGORY_PRODUCT.aggregate(report_input(spark, sf_dir, DAILY_CATEGORY_PRODUCT))
    rolled = roll_up(by_product, "ts_date", "daily_rev", "rev_a2")
    direct = roll_up(daily_records(spark, sf_dir, ["ts_date", "revenue"]), "ts_date", "revenue", "rev_a1")
    same = F.abs(F.col("rev_a1") - F.col("rev_a2")) < 0.005
    return direct.join(rolled, "ts_date", "full").select(
        "ts_date", money("rev_a1"), money("rev_a2"), F.coalesce(same, F.lit(False)).alias("same")
    )


# Projections, dimensions, lookup, dedup


def list_price_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = list_price(F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select(line_id().alias("ts_id"), price.alias("price"))


def record_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_records(spark, sf_dir, ["ts_id", "ts_date", "revenue", "profit"])


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.customer_dim(sample_sales(spark, sf_dir, CUSTOMER_FIELDS))


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.product_dim(sample_sales(spark, sf_dir, PRODUCT_SALE_FIELDS))


def geocode_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gazetteer without Europe: records from there have no place and are dropped."""
    known = gazetteer(spark, sf_dir).filter(F.col("country") != "EUROPE")
    records = daily_records(spark, sf_dir, ["ts_id", "country", "city"])
    return geocode(records, known).select("ts_id", "latitude", "longitude")


def raw_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written again under the same order and line number replace one another."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select(*columns)
    return latest_by(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


# Messages


def readable(rows: DataFrame) -> DataFrame:
    """Records with times as text and 32-bit amounts as doubles, which compare exactly."""
    amounts = [F.col(c).cast("double").alias(c) for c in ("price", "revenue", "profit")]
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts")
    changed = {"ts": time, **dict(zip(("price", "revenue", "profit"), amounts))}
    return rows.select(*[changed.get(c, F.col(c)) for c in RECORD_FIELDS])


def decode_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readable(decode(event_messages(spark, sf_dir), RECORD))


def encode_records_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all 18 fields, then read the message back as text and numbers."""
    records = located_records(spark, sf_dir, list(MESSAGE_FIELDS))
    sent = encode_records(records)
    numbers = {"price", "revenue", "profit", "latitude", "longitude"}
    schema = T.StructType(
        [T.StructField(n, T.DoubleType() if n in numbers else T.StringType()) for n in MESSAGE_FIELDS]
    )
    return decode(sent, schema, "key")


def stacked(rows: dict[str, DataFrame]) -> DataFrame:
    """All rows of several reports, with the report's name; what one lacks is null."""
    named = [df.select(F.lit(name).alias("report"), "*") for name, df in rows.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def exact_reports(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {r.name: r.aggregate(report_input(spark, sf_dir, r), exact=True) for r in REPORTS.values()}


def encode_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each report written as one version of its changelog and read back by field name."""
    found = {}
    for name, rows in exact_reports(spark, sf_dir).items():
        path = new_folder(spark, "changelog")
        write_version(rows, path, 0, 0, level=False)
        found[name] = tidy(_typed_report(REPORTS[name], read_changelog(spark, path)).drop(VERSION))
    return stacked(found)


def _typed_report(report: Report, messages: DataFrame) -> DataFrame:
    typed = to_report_types(report, messages)
    return typed.filter(F.col(REASON).isNull()).select(*report.columns, VERSION)


def damaged_messages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Event messages, those of some kinds damaged: each reason for quarantine occurs."""
    kind = F.col("category")
    fields = [F.when(kind != "click", F.col("ts_id")).alias("ts_id"), *MESSAGE_FIELDS[1:]]
    whole = F.to_json(F.struct(*fields))
    value = (
        F.when(kind == "error", F.concat(F.lit("not json "), whole))
        .when(kind == "signup", F.regexp_replace(whole, '"quantity":', '"quantity":0.5,"was":'))
        .when((kind == "view") & (F.col("revenue") < 5), "")
        .otherwise(whole)
    )
    records = event_records(spark, sf_dir, events)
    return records.select(F.col("ts_id").alias("key"), value.alias("value"), "ts_date", *place_of(records))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inspect(damaged_messages(spark, sf_dir))
    return rows.groupBy(F.coalesce(REASON, F.lit("good")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def good_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the damaged feed: only good records count."""
    rows = good(inspect(damaged_messages(spark, sf_dir)))
    return tidy(DAILY_CATEGORY_PRODUCT.aggregate(rows))


# Keyed tables


def kept_without_database(rows: DataFrame, database: str) -> DataFrame:
    """``rows``, written to the scratch folder, after the database they came from is gone."""
    spark, path = rows.sparkSession, new_folder(rows.sparkSession, "result")
    rows.write.parquet(path)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.schema(rows.schema).parquet(path)


def _report_tables(spark: SparkSession, sf_dir: str, suffix: str = "") -> dict[str, DataFrame]:
    """Text totals of all reports through changelogs into declared tables, read by SQL."""
    root, database = new_folder(spark, "tables"), f"daily_report_{uuid.uuid4().hex}"

    def make(report: Report) -> None:
        records = report_input(spark, sf_dir, report)
        places = [c for c in ("latitude", "longitude") if c in report.inputs]
        sent = records.withColumns({c: F.col(c).cast("string") for c in places}) if places else records
        path = f"{root}/{report.name}"
        write_version(report.aggregate(sent, exact=True), f"{path}/changelog", 0, 0, level=False)
        write_changes(report, _typed_report(report, read_changelog(spark, f"{path}/changelog")), f"{path}/changes", 0, 0)

    # Side by side: the last tasks of one report's stages leave cores to the others.
    with settings(spark, {"spark.sql.adaptive.enabled": "true"}), ThreadPoolExecutor(len(REPORTS)) as pool:
        list(pool.map(inheritable_thread_target(spark)(make), REPORTS.values()))
    create_tables(spark, database, root, list(REPORTS.values()))
    return {"database": database, **{n: spark.table(f"{database}.{n}{suffix}") for n in REPORTS}}


def typed_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three typed tables."""
    tables = _report_tables(spark, sf_dir)
    database = tables.pop("database")
    return kept_without_database(stacked({n: tidy(rows) for n, rows in tables.items()}), database)


def text_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tables as text; sums are cast back to compare them to the cent."""
    tables = _report_tables(spark, sf_dir, "_text")
    database = tables.pop("database")
    sums = ("daily_rev", "daily_profit")
    back = lambda rows: rows.withColumns({c: F.round(F.col(c).cast("double"), 2) for c in sums if c in rows.columns})
    return kept_without_database(stacked({n: back(rows) for n, rows in tables.items()}), database)


def running_changelog(spark: SparkSession, sf_dir: str, report: Report) -> DataFrame:
    """A changelog of totals so far, the line number of an order serving as version.

    Records are read once and summed per key, version and customer before anything
    else. A customer is new in the first version that has them, so new customers add up
    like any sum. Both windows then go over the few versions of a key, never its records.
    """
    keys = report.key_names
    lines = report_input(spark, sf_dir, report, VERSION)
    source = {m.name: m.source for m in report.measures}
    if any(m.kind == "users" for m in report.measures):
        sums = [F.sum(m.source).alias(m.name) for m in report.measures if m.kind == "sum"]
        per_user = lines.groupBy(*keys, VERSION, "customer_id").agg(F.count("customer_id").alias("n"), *sums)
        first = F.min(VERSION).over(Window.partitionBy(*keys, "customer_id"))
        is_new = (F.col("n") > 0) & (F.col(VERSION) == first)
        lines = per_user.withColumn("daily_pu", is_new.cast("bigint"))
        source = {m.name: m.name for m in report.measures}
    steps = lines.groupBy(*keys, VERSION).agg(*[F.sum(source[m]).alias(m) for m in report.measure_names])
    so_far = Window.partitionBy(*keys).orderBy(VERSION).rowsBetween(Window.unboundedPreceding, 0)
    return steps.select(*keys, VERSION, *[F.sum(m).over(so_far).alias(m) for m in report.measure_names])


def _upsert(spark: SparkSession, sf_dir: str, report: Report) -> DataFrame:
    """Versions through the stored table: the later half first, then all of them, so that
    some come late and some twice; a snapshot is made between. The versions are computed once."""
    root = new_folder(spark, "upsert")
    running_changelog(spark, sf_dir, report).withColumn(VERSION, F.col(VERSION).cast("bigint")).write.parquet(f"{root}/versions")
    changes = spark.read.parquet(f"{root}/versions")
    write_changes(report, changes.filter(F.col(VERSION) > 3), f"{root}/changes", 0, 0)
    compact(spark, report, root)
    write_changes(report, changes, f"{root}/changes", 0, 1)
    write_changes(report, changes.filter(F.col(VERSION) < 3), f"{root}/changes", 0, 2)
    return tidy(latest_rows(report, read_changes(spark, report, root), keep_version=True))


def upsert_daily_pu_rev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, DAILY_PU_REV)


def upsert_daily_category_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, DAILY_CATEGORY_PRODUCT)


def upsert_daily_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, DAILY_ADDRESS)


# Files and generation


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "sample-csv")
    files.write_csv(sample_sales(spark, sf_dir), path)
    return files.read_csv(spark, path, nullable(SAMPLE_CSV))


def daily_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 18 fields by day, gzip; every row of every day's files."""
    path = new_folder(spark, "export")
    files.export_daily(located_records(spark, sf_dir, list(MESSAGE_FIELDS)), path)
    return spark.read.parquet(path)


def _synthetic(spark: SparkSession, sf_dir: str, per_customer: bool) -> DataFrame:
    root = new_folder(spark, "dimensions")
    buyers = dimensions.customer_dim(customers(spark, sf_dir, CUSTOMER_FIELDS))
    dimensions.indexed_customers(buyers).write.parquet(f"{root}/customers")
    goods = dimensions.product_dim(sample_sales(spark, sf_dir, PRODUCT_SALE_FIELDS))
    dimensions.indexed_products(goods).write.parquet(f"{root}/products")
    buyers, goods = spark.read.parquet(f"{root}/customers"), spark.read.parquet(f"{root}/products")
    limit = buyers.count() if per_customer else generator.MAX_PER_DAY
    wanted = generator.tries(spark, SEED, max_per_day=limit)
    records = generator.synthesize(wanted, buyers, goods, gazetteer(spark, sf_dir), SEED)
    return records.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


def synth_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of 1 to 30 records a day, drawn from the whole dimensions."""
    return _synthetic(spark, sf_dir, per_customer=False)


def synth_records_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of 1 to as many records a day as there are customers."""
    return _synthetic(spark, sf_dir, per_customer=True)
