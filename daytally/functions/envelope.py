"""JSON messages: decode to typed columns, set bad ones aside, encode back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.schemas import MESSAGE_FIELDS, RECORD, nullable

CORRUPT = "_corrupt"
REASON = "reason"
RAW = "raw_value"

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def decode(messages: DataFrame, schema: T.StructType, *carry: str) -> DataFrame:
    """Turn a ``value`` column of JSON text or bytes into the columns of ``schema``.

    Unknown fields are dropped, missing ones are null, and a value that is not an
    object gives a row of nulls. ``carry`` names columns to keep beside the fields.
    """
    data = F.from_json(F.col("value").cast("string"), nullable(schema))
    return messages.select(data.alias("data"), *carry).select("data.*", *carry)


def inspect(
    messages: DataFrame,
    schema: T.StructType = RECORD,
    required: Sequence[str] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Decode and judge in one pass: adds ``reason`` (null for a good row) and the text.

    ``empty``       no text at all
    ``malformed``   not a JSON object, or a field of the wrong type
    ``incomplete``  a required field is missing or null
    """
    if required is None:
        required = [f.name for f in schema if not f.nullable]
    with_corrupt = nullable(schema).add(CORRUPT, T.StringType())
    # The generator keeps the parse where it is. Behind a plain projection a filter on
    # ``reason`` would be moved below the parse and repeat it once for every field.
    parse = F.from_json(RAW, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    parsed = messages.select(F.col("value").cast("string").alias(RAW), *carry).select(
        RAW, *carry, F.inline(F.array(parse))
    )
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    reason = (
        F.when(F.col(RAW).isNull() | (F.trim(RAW) == ""), "empty")
        .when(F.col(CORRUPT).isNotNull(), "malformed")
        .when(missing, "incomplete")
    )
    return parsed.select(*schema.fieldNames(), *carry, RAW, reason.alias(REASON))


def good(inspected: DataFrame) -> DataFrame:
    return inspected.filter(F.col(REASON).isNull()).drop(REASON, RAW)


def bad(inspected: DataFrame) -> DataFrame:
    return inspected.filter(F.col(REASON).isNotNull()).select(REASON, RAW)


def encode(rows: DataFrame, *carry: str) -> DataFrame:
    """``value`` = one JSON object of all other columns; null fields are left out."""
    fields = [c for c in rows.columns if c not in carry]
    return rows.select(F.to_json(F.struct(*fields)).alias("value"), *carry)


def message_fields(records: DataFrame) -> list[Column]:
    """The 18 fields in sending form: times and the discount as text."""
    as_text = {
        "ts": F.date_format("ts", TS_FORMAT),
        "ts_date": F.date_format("ts_date", "yyyy-MM-dd"),
        "discount": F.col("discount").cast("string"),
    }
    return [as_text.get(name, F.col(name)).alias(name) for name in MESSAGE_FIELDS]


def encode_records(records: DataFrame) -> DataFrame:
    """Messages as the producer sends them: ``key`` = ts_id, ``value`` = JSON."""
    return records.select(
        F.col("ts_id").alias("key"),
        F.to_json(F.struct(*message_fields(records))).alias("value"),
    )
