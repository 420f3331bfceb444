"""File sources and sinks: topic files, CSV samples, daily exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.functions.envelope import message_fields
from daytally.session import ensure_folder, folder_exists, is_complete

MAX_BYTES_PER_TRIGGER = 64 * 1024**3

# Of topic files: messages are parsed by as many tasks as there are row groups.
ROW_GROUP_BYTES = 16 * 1024**2

OFFSET = "offset"
KEY = "key"

# Of messages that no longer stand in the order they are to be sent in: their places.
POSITION = "position"

# A topic as files: what a message broker gives, as far as it is used here.
TOPIC = T.StructType().add(KEY, T.StringType()).add("value", T.StringType()).add(OFFSET, T.LongType())


def batch_limit(options: dict[str, str], max_bytes: int = MAX_BYTES_PER_TRIGGER) -> dict[str, str]:
    """Bound a micro-batch by size, so that a long backlog is worked off in steps."""
    return options if "maxFilesPerTrigger" in options else {"maxBytesPerTrigger": str(max_bytes), **options}


def read_topic_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A topic folder as a stream of ``key``, ``value`` and ``offset``."""
    reader = spark.readStream.schema(TOPIC).options(**batch_limit(options))
    return reader.parquet(ensure_folder(spark, path)).select(*TOPIC.fieldNames())


def topic_messages(spark: SparkSession, path: str) -> DataFrame:
    """All messages of a topic folder, as a table."""
    return spark.read.schema(TOPIC).parquet(path).select(*TOPIC.fieldNames())


def append_topic_files(messages: DataFrame, path: str, send: str) -> None:
    """Add messages to a topic folder, with their ``key`` if they have one.

    ``send`` names this sending. One that is complete is left as it is, so a sender may
    try again after a crash. Offsets go on from the highest one in the topic, whatever
    any clock says; within a sending they follow the order of its rows, or their
    ``position`` if they have one. One sender at a time may write to a topic folder.
    """
    spark, folder = messages.sparkSession, f"{path}/send={send}"
    if is_complete(spark, folder):
        return
    first = 0
    if folder_exists(spark, path):
        sent = spark.read.schema(T.StructType([*TOPIC, T.StructField("send", T.StringType())])).parquet(path)
        last = sent.filter(F.col("send") != send).agg(F.max(OFFSET)).first()[0]
        first = 0 if last is None else last + 1
    key = F.col(KEY).cast("string") if KEY in messages.columns else F.lit(None).cast("string")
    place = F.col(POSITION) if POSITION in messages.columns else F.monotonically_increasing_id()
    offset = (F.lit(first) + place).alias(OFFSET)
    rows = messages.select(key.alias(KEY), F.col("value").cast("string").alias("value"), offset)
    rows.write.mode("overwrite").option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(folder)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and declared types: no extra pass to guess them."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def export_daily(records: DataFrame, path: str) -> None:
    """Gzip parquet by day. A day present in ``records`` replaces that day's files.

    Rows are rebalanced by day before the write: runtime planning joins small days in
    one task and cuts a day too big for one task into several files.
    """
    rows = records.select(
        *message_fields(records.withColumn("_day", F.col("ts_date"))), F.col("ts_date").alias("day")
    )
    (
        rows.hint("rebalance", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy("day")
        .parquet(path)
    )
