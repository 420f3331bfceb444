"""The one place where record and dimension types are declared."""

from __future__ import annotations

from pyspark.sql import types as T

# A decoded sales record. Every field is required: a record that lacks one is set
# aside. Coordinates stay text here because they are compared as text when grouped.
RECORD = (
    T.StructType()
    .add("ts_id", T.StringType(), False)
    .add("ts", T.TimestampType(), False)
    .add("ts_date", T.DateType(), False)
    .add("customer_id", T.StringType(), False)
    .add("customer_name", T.StringType(), False)
    .add("segment", T.StringType(), False)
    .add("country", T.StringType(), False)
    .add("city", T.StringType(), False)
    .add("category", T.StringType(), False)
    .add("sub_category", T.StringType(), False)
    .add("product_name", T.StringType(), False)
    .add("price", T.FloatType(), False)
    .add("quantity", T.IntegerType(), False)
    .add("revenue", T.FloatType(), False)
    .add("profit", T.FloatType(), False)
    .add("latitude", T.StringType(), False)
    .add("longitude", T.StringType(), False)
)

RECORD_FIELDS = tuple(RECORD.fieldNames())

# Order of the fields of a message as the producer sends it.
MESSAGE_FIELDS = (
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
    "latitude",
    "longitude",
)

CUSTOMER_FIELDS = ("customer_id", "customer_name", "segment", "country", "city")
PRODUCT_FIELDS = ("category", "sub_category", "product_name", "price")

# What the sample must have for a product to be found and priced.
PRODUCT_SALE_FIELDS = ("category", "sub_category", "product_name", "sales", "quantity", "discount")

SAMPLE_CSV = (
    T.StructType()
    .add("customer_id", T.StringType())
    .add("customer_name", T.StringType())
    .add("segment", T.StringType())
    .add("country", T.StringType())
    .add("city", T.StringType())
    .add("category", T.StringType())
    .add("sub_category", T.StringType())
    .add("product_name", T.StringType())
    .add("sales", T.DoubleType())
    .add("quantity", T.IntegerType())
    .add("discount", T.DoubleType())
)

GAZETTEER = (
    T.StructType()
    .add("country", T.StringType())
    .add("city", T.StringType())
    .add("latitude", T.DoubleType())
    .add("longitude", T.DoubleType())
)


def nullable(schema: T.StructType) -> T.StructType:
    """The same fields without the NOT NULL marks, which readers do not enforce."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
