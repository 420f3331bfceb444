"""Bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import fold, unit, written

#: Labelled rows that a model is fitted on, about, however many there are.
TRAIN_ROWS = 20_000
SEED = 7


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, rows: int = TRAIN_ROWS, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(key, text, label) of about ``rows`` labelled documents that are not ``held_out``
    (a condition on ``key``), drawn by the hash of the key. Null labels and keys are left
    out; of several labels for one key the largest counts."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter("key IS NOT NULL AND label IS NOT NULL")
    known = known.groupBy("key").agg(F.max("label").alias("label")).filter(~held_out)
    share = min(1.0, rows / max(1, known.count()))
    drawn = F.broadcast(written(known.filter(unit(F.col("key"), SEED) < share), "sample"))  # about ``rows`` rows of two numbers
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.join(drawn, "key").select("key", "text", "label")


def in_fold(folds: int, which: int, key: str = "key") -> Column:
    return fold(F.col(key), folds) == which
