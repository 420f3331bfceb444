"""Quality by logistic regression on hashed word n-grams, trained by
follow-the-regularised-leader steps and scored as sparse dot products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import unit
from daytally.llm.training import TRAIN_ROWS, labelled_sample
from daytally.llm.words import EXACT, hashed_words, mix

BITS = 18
SIZE = 1 << BITS
EPOCHS = 4
#: Models trained side by side on shards of the sample, then averaged.
SHARDS = 4
RATE, SMOOTH, L1, L2 = 0.3, 1.0, 0.02, 1.0
_SEED = 11


def _bytes(kept) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[*kept]] = True
    return table


LETTERS = _bytes([*(b for b in range(128) if chr(b).isalnum()), *range(128, 256)])
MARKS = _bytes(b for b in range(33, 127) if not chr(b).isalnum())
_PAIR, _AGAIN, _MARK = (np.uint64(x) for x in (0x8CB92BA72F3D8DD7, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _features(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """For each text the places of its features, repeats included: words, pairs of words,
    runs of marks, and the mark of a word that follows itself."""
    shift = np.uint64(64 - BITS)
    runs = zip(hashed_words(column, LETTERS, EXACT), hashed_words(column, MARKS, EXACT))
    for (_, _, words, at), (_, _, marks, mark_at) in runs:
        pairs = mix(words[:-1] * _PAIR + words[1:]) if len(words) > 1 else words[:0]
        again = np.concatenate([[False], words[1:] == words[:-1]]) if len(words) else np.zeros(0, bool)
        one, two = (words >> shift).astype(np.int32), (pairs >> shift).astype(np.int32)
        signs = (mix(marks ^ _MARK) >> shift).astype(np.int32)
        same = np.int32(int(_AGAIN) >> (64 - BITS))
        out = []
        for i in range(len(at) - 1):
            a, b = at[i], at[i + 1]
            repeats = int(again[a + 1 : b].sum())
            out.append(np.concatenate([one[a:b], two[a : max(a, b - 1)], signs[mark_at[i] : mark_at[i + 1]], np.full(repeats, same)]))
        yield out


def _margin(weights: np.ndarray, bias: float, places: np.ndarray) -> float:
    return bias + (float(weights[places].sum()) / np.sqrt(len(places)) if len(places) else 0.0)


class Leader:
    """The regularised leader's state: one weight for each place, and a bias."""

    def __init__(self):
        self.z, self.n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((SMOOTH + np.sqrt(self.n[at])) / RATE + L2)

    def step(self, at: np.ndarray, values: np.ndarray, label: float) -> None:
        w = self.weights(at)
        slope = (1 / (1 + np.exp(-np.clip(w @ values, -30, 30))) - label) * values
        grown = self.n[at] + slope * slope
        self.z[at] += slope - (np.sqrt(grown) - np.sqrt(self.n[at])) / RATE * w
        self.n[at] = grown


def _trained(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int) -> np.ndarray:
    leader = Leader()
    for _ in range(epochs):
        for row in rows:
            leader.step(*row)
    return leader.weights(slice(None))


def _train(batches: Iterator[pa.RecordBatch], epochs: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by shard: (shard, number of rows, weights as 4-byte numbers)."""
    shard, rows = None, []

    def done() -> pa.RecordBatch:
        weights = _trained(rows, epochs).astype("<f4").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([len(rows)], pa.int64()), pa.array([weights], pa.binary())], names=["shard", "n", "weights"])

    for batch in batches:
        known = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        for some in _features(batch.column(0)):
            for places, (label, own) in zip(some, known):
                if own != shard:
                    if rows:
                        yield done()
                    shard, rows = own, []
                at, n = np.unique(places, return_counts=True)
                values = n / np.sqrt(max(1, len(places)))
                rows.append((np.append(at, SIZE), np.append(values, 1.0).astype(np.float32), float(label)))
    if rows:
        yield done()


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", rows: int = TRAIN_ROWS, text: str = "text", key: str = "doc_id") -> np.ndarray:
    """Weights from about ``rows`` labelled documents that are not ``held_out``, the last
    one the bias: those of one model for each of SHARDS parts of the rows, averaged by their
    numbers of rows. A row's part is drawn by its key, so the weights do not depend on how
    the tables or the shuffle are cut. SHARDS vectors of 1 MB reach the driver. Without
    labels all are zero."""
    sample = labelled_sample(docs, labels, label, held_out, rows, text, key)
    sharded = sample.withColumn("draw", unit(F.col("key"), _SEED)).withColumn("shard", F.floor(F.col("draw") * SHARDS).cast("long"))
    ordered = sharded.repartition(SHARDS, "shard").sortWithinPartitions("shard", "draw", "label", F.xxhash64("text")).select("text", "label", "shard")
    models = ordered.mapInArrow(lambda batches: _train(batches, EPOCHS), "shard long, n long, weights binary").collect()
    models.sort(key=lambda m: m["shard"])
    vectors = [np.frombuffer(m["weights"], "<f4") for m in models]
    return np.average(vectors, axis=0, weights=[m["n"] for m in models]).astype(np.float32) if vectors else np.zeros(SIZE + 1, np.float32)


def _score_rows(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    own, bias = weights[:SIZE], float(weights[SIZE])
    for batch in batches:
        margins = np.array([_margin(own, bias, places) for some in _features(batch.column(1)) for places in some])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(margins, -30, 30))))], names=["key", "score"])


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, score) for every row, between 0 and 1.

    A null or empty text has no features, so the bias alone is its score. A text of any
    length is scored whole; null keys pass. Equal rows get equal scores, so ties stay ties;
    an empty table gives an empty result; other columns do not pass.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _score_rows(batches, weights), f"key {kind}, score double").withColumnRenamed("key", key)
