"""Message-topic connector options.

Only the options are built and tested here: the connector package is not part of
Spark's own distribution and has to be on the cluster's class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def source_options(
    servers: str, topic: str, max_offsets: int | None = None, fail_on_data_loss: bool = False
) -> dict[str, str]:
    """Read one topic from its start. By default go on if old messages are gone, which the
    broker's retention may do at any time; totals are then short. ``fail_on_data_loss``
    ends the query instead."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_topic(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None, fail_on_data_loss: bool = False
) -> DataFrame:
    options = source_options(servers, topic, max_offsets, fail_on_data_loss)
    return spark.readStream.format("kafka").options(**options).load()


def send_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a table of ``value`` (and optionally ``key``) columns, once each at least."""
    messages.write.format("kafka").options(**sink_options(servers, topic)).save()
