"""Customer and product dimensions, and a dense row index made without one big sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.functions.pricing import list_price
from daytally.schemas import CUSTOMER_FIELDS, PRODUCT_FIELDS

# Hex digits of the bucket name: 16^4 = 65,536 buckets.
BUCKET_DIGITS = 4


def customer_dim(sample: DataFrame) -> DataFrame:
    return sample.select(*CUSTOMER_FIELDS).distinct()


def product_dim(sample: DataFrame) -> DataFrame:
    """Distinct products with their list price; two prices make two rows."""
    price = list_price(F.col("sales"), F.col("quantity"), F.col("discount")).alias("price")
    return sample.select("category", "sub_category", "product_name", price).select(*PRODUCT_FIELDS).distinct()


def bucket_of(*texts: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("|", *texts)), 1, BUCKET_DIGITS)


def with_index(rows: DataFrame, bucket: Column, order: list[str], name: str = "idx") -> DataFrame:
    """Number distinct rows 0..n-1 in a repeatable way.

    Rows are numbered inside 65,536 hash buckets, each a small sort of its own, and then
    shifted by the size of the buckets before. Only the bucket sizes meet in one task,
    so that task stays as small however many rows there are.
    """
    bucketed = rows.withColumn("_bucket", bucket)
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_bucket").orderBy(*order)
    numbered = bucketed.withColumn("_place", F.row_number().over(inside) - 1)
    index = (F.col("_place") + F.col("_shift")).cast("bigint").alias(name)
    # At most 65,536 rows by construction, so this side may always be broadcast.
    return numbered.join(F.broadcast(shifts), "_bucket").select(index, *rows.columns)


def indexed_customers(customers: DataFrame) -> DataFrame:
    return with_index(customers, bucket_of(*[F.col(c) for c in CUSTOMER_FIELDS]), list(CUSTOMER_FIELDS))


def indexed_products(products: DataFrame) -> DataFrame:
    """Bucketed by name and price (in whole millionths, whose text is the same
    everywhere): one product with very many prices spreads."""
    millionths = F.floor(F.col("price") * 1_000_000).cast("bigint").cast("string")
    bucket = bucket_of(F.col("category"), F.col("sub_category"), F.col("product_name"), millionths)
    return with_index(products, bucket, list(PRODUCT_FIELDS))
