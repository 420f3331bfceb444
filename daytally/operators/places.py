"""City to coordinates: a lookup join in place of a geocoder call per record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """Inner join of many facts to a lookup table that has each key once.

    A batch leaves the choice to Spark, which knows the sizes when it runs and splits
    hot keys. A stream keeps its plan for life, without either, so there both sides are
    salted: facts go to a part of their key by a hash of ``spread_by``, the lookup row
    to all parts. There are as many parts as the session shuffles to, so one key that
    has most of the facts still keeps all tasks busy.
    """
    keys = list(keys)
    if not facts.isStreaming:
        return facts.join(lookup, keys, "inner")
    salts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (
        facts.withColumn("_salt", salt)
        .join(lookup.withColumn("_salt", parts), [*keys, "_salt"], "inner")
        .drop("_salt")
    )


def one_place_per_name(gazetteer: DataFrame) -> DataFrame:
    """A place name has one location; of several the least is taken."""
    place = F.min(F.struct("latitude", "longitude")).alias("place")
    return gazetteer.groupBy("country", "city").agg(place).select("country", "city", "place.*")


def geocode(records: DataFrame, gazetteer: DataFrame, spread_by: Sequence[str] = ("ts_id",)) -> DataFrame:
    """Add ``latitude`` and ``longitude``; records of an unknown place are dropped."""
    places = one_place_per_name(gazetteer).select(
        "country", "city", F.col("latitude").cast("double"), F.col("longitude").cast("double")
    )
    return lookup_join(records, places, ["country", "city"], spread_by)
