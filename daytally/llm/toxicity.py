"""Toxic passages by maximal scoring segments, and a document's score from them.

A token's score is its log-odds between toxic and other training documents under a
Dirichlet prior; other tokens pull down by a constant, so that random text scores below
zero. One scan of a text finds all maximal segments. How large a segment chance alone
gives follows an extreme-value law, whose two constants come from the training documents
that are not toxic; what exceeds it, over all segments of a document, is turned into a
probability by a logistic curve.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import keep_batches_small, tidily, written
from daytally.llm.training import TRAIN_ROWS, labelled_sample
from daytally.llm.words import BY_LETTER, hashed_words

#: The prior: so much for every token, and a mass spread by how many documents have it.
FLAT, PRIOR = 0.5, 100.0
#: Scores kept: tokens this many standard errors from no difference, and with at least
#: this difference; the most significant ones, up to a bound.
ERRORS = 2.5
LEAST = float(np.log(3.0))
TOKENS = 1 << 16
#: What any other token adds.
DRIFT = -0.02


@dataclass(frozen=True)
class Scores:
    """Token hashes, ascending, and their scores; the two constants of the law of the
    largest segment; the logistic weights of :func:`features`."""

    tokens: np.ndarray
    scores: np.ndarray
    rate: float = 1.0
    scale: float = 1.0
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of a task's documents of each label a token occurs."""
    for batch in batches:
        label = batch.column(1).to_numpy()
        for first, last, hashes, bounds in hashed_words(batch.column(0), BY_LETTER):
            sets = [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:])]
            toxic = np.repeat(label[first:last], [len(s) for s in sets])
            tokens, where = np.unique(np.concatenate(sets), return_inverse=True)
            n = np.bincount(where, minlength=len(tokens))
            n1 = np.bincount(where, toxic, len(tokens)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n1), pa.array(n - n1)], names=["token", "n1", "n0"])


def token_scores(sample: DataFrame) -> Scores:
    counts = sample.select("text", "label").mapInArrow(lambda batches: tidily(_presence(batches)), "token long, n1 long, n0 long")
    counts = written(counts.groupBy("token").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), "tokens")
    all1, all0, n = counts.agg(F.coalesce(F.sum("n1"), F.lit(0)), F.coalesce(F.sum("n0"), F.lit(0)), F.count(F.lit(1))).first()
    prior = F.lit(FLAT) + F.lit(PRIOR) * (F.col("n1") + F.col("n0")) / F.lit(max(1, all1 + all0))
    mass = FLAT * n + PRIOR

    def logit(n: str, total: int) -> Column:
        return F.log((F.col(n) + prior) / (F.lit(total + mass) - F.col(n) - prior))

    difference = logit("n1", all1) - logit("n0", all0)
    error = F.sqrt(1 / (F.col("n1") + prior) + 1 / (F.col("n0") + prior))
    scored = counts.select("token", difference.alias("score"), F.abs(difference / error).alias("z"))
    best = scored.filter((F.col("z") >= ERRORS) & (F.abs("score") >= LEAST)).orderBy(F.desc("z"), "token").limit(TOKENS).toPandas()
    tokens = best["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return Scores(tokens[order], best["score"].to_numpy(float)[order])


def maximal_segments(places: np.ndarray, scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last) of a sequence in which every
    place not among ``places`` adds DRIFT: one scan, in time linear in the places.

    Each candidate keeps a link to the nearest one before it that begins at a lower total;
    those in between begin no lower than itself, so a search that passes it may skip them.
    """
    found: list[tuple[float, float, int, int, int]] = []  # total before, total after, first, last, link
    total, at = 0.0, -1
    for place, score in zip(places.tolist(), scores.tolist()):
        total += DRIFT * (place - at - 1)
        low, total, at = total, total + score, place
        if score <= 0:
            continue
        first, j = place, len(found) - 1
        while j >= 0 and found[j][0] >= low:
            j = found[j][4]
        while j >= 0 and found[j][1] < total:
            low, _, first, _, link = found[j]
            del found[j:]
            j = link
        found.append((low, total, first, place, j))
    return [(high - low, first, last) for low, high, first, last, _ in found]


def _scored(column: pa.Array, model: Scores) -> Iterator[tuple[int, list[tuple[float, int, int]]]]:
    """For each text: its number of tokens and its maximal segments."""
    for _, _, hashes, bounds in hashed_words(column, BY_LETTER):
        if len(model.tokens) and len(hashes):
            at = np.minimum(np.searchsorted(model.tokens, hashes), len(model.tokens) - 1)
            known = np.flatnonzero(model.tokens[at] == hashes)
            scores = model.scores[at[known]]
        else:
            known, scores = np.empty(0, np.int64), np.empty(0)
        cuts = np.searchsorted(known, bounds)
        for i in range(len(bounds) - 1):
            own = slice(cuts[i], cuts[i + 1])
            yield int(bounds[i + 1] - bounds[i]), maximal_segments(known[own] - bounds[i], scores[own])


def features(n: int, segments: list[tuple[float, int, int]], model: Scores) -> tuple[float, float, float, float]:
    """1, the largest segment's score above what chance gives in a text of ``n`` tokens,
    the sum of such excess over all significant segments, and the log of ``n``."""
    if not segments:
        return 1.0, 0.0, 0.0, float(np.log1p(n))
    chance = np.log(max(model.scale * n, 1e-9))
    normal = [model.rate * s - chance for s, _, _ in segments]
    return 1.0, max(0.0, model.rate * max(s for s, _, _ in segments)), sum(x for x in normal if x > 0), float(np.log1p(n))


def _segment_rows(batches: Iterator[pa.RecordBatch], model: Scores) -> Iterator[pa.RecordBatch]:
    """(n, score): of each text its number of tokens once, and the score of each segment."""
    for batch in batches:
        for n, segments in _scored(batch.column(0), model):
            columns = [pa.array([n] + [None] * len(segments), pa.int64()), pa.array([None, *(s for s, _, _ in segments)], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["n", "score"])


def _feature_rows(batches: Iterator[pa.RecordBatch], model: Scores) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [features(n, segments, model) for n, segments in _scored(batch.column(0), model)]
        columns = [pa.array([row[i] for row in x], pa.float64()) for i in range(4)]
        yield pa.RecordBatch.from_arrays([batch.column(1), *columns], names=["label", "x0", "x1", "x2", "x3"])


def _rate(scores: np.ndarray, counts: np.ndarray, n: int) -> float:
    """The rate of the law: at which E[exp(rate * score)] is 1 for the ``n`` tokens of texts
    that are not toxic, ``counts`` of which have ``scores``."""
    share = counts / max(1, n)
    low, high = 1e-3, 1.0
    mean = lambda r: float(share @ np.exp(r * scores) + (1 - share.sum()) * np.exp(r * DRIFT))
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return high


def _scale(segments: DataFrame, rate: float, n: int) -> float:
    """The scale of the law: such that it gives as many segments above their median score as
    there are. Only the median and a count leave the tasks."""
    at = segments.agg(F.percentile_approx("score", 0.5, 10_000)).first()[0]
    if at is None:
        return 1.0
    above = segments.filter(F.col("score") >= at - 1e-9).count()  # equal segments differ in their last bits
    return float(above * np.exp(rate * at) / max(1, n))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    w = np.zeros(x.shape[1])
    if not len(y):
        return tuple(w)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + 1e-3 * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w)), slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def _token_counts(batches: Iterator[pa.RecordBatch], model: Scores) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(len(model.tokens), np.int64)
    for batch in batches:
        for _, _, hashes, _ in hashed_words(batch.column(0), BY_LETTER):
            if len(counts) and len(hashes):
                at = np.minimum(np.searchsorted(model.tokens, hashes), len(counts) - 1)
                counts += np.bincount(at[model.tokens[at] == hashes], minlength=len(counts))
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["at", "n"])


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", rows: int = TRAIN_ROWS, text: str = "text", key: str = "doc_id") -> Scores:
    """A model from about ``rows`` labelled documents that are not ``held_out``. What reaches
    the driver is bounded by ``rows`` (four numbers of each text, however long it is) and
    TOKENS. Without labels every score is 0.5."""
    sample = written(labelled_sample(docs, labels, label, held_out, rows, text, key), "training")
    model = token_scores(sample)
    others = sample.filter("label = 0").select("text")
    known = others.mapInArrow(lambda batches: tidily(_token_counts(batches, model)), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(model.tokens))
    counts[known["at"].to_numpy(np.int64)] = known["n"].to_numpy(float)
    segments = written(others.mapInArrow(lambda batches: tidily(_segment_rows(batches, model)), "n long, score double"), "segments")
    n = segments.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rate = _rate(model.scores, counts, n)
    model = Scores(model.tokens, model.scores, rate, _scale(segments.filter("score IS NOT NULL"), rate, n))
    found = sample.select("text", "label").mapInArrow(lambda batches: tidily(_feature_rows(batches, model)), "label int, x0 double, x1 double, x2 double, x3 double").toPandas()
    weights = _logistic(found[["x0", "x1", "x2", "x3"]].to_numpy(float), found["label"].to_numpy(float))
    return Scores(model.tokens, model.scores, model.rate, model.scale, weights)


_SCORED = "key {kind}, score double, n_passages int, passages array<struct<first:int,last:int,score:double>>"


def _score_rows(batches: Iterator[pa.RecordBatch], model: Scores) -> Iterator[pa.RecordBatch]:
    passage = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))
    for batch in batches:
        scores, passages = [], []
        for n, segments in _scored(batch.column(1), model):
            z = float(np.dot(model.weights, features(n, segments, model)))
            scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            chance = np.log(max(model.scale * n, 1e-9))
            passages.append([{"first": a, "last": b, "score": s} for s, a, b in segments if model.rate * s > chance])
        columns = [pa.array(scores, pa.float64()), pa.array([len(p) for p in passages], pa.int32()), pa.array(passages, passage)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["key", "score", "n_passages", "passages"])


def score(docs: DataFrame, model: Scores, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, score, n_passages, passages) for every row: ``score`` between 0 and 1, and
    each significant passage by its first and last token (counted from 0) and score.

    A null or empty text has no tokens and the score of a text without any. A text of any
    length is scored whole, in time linear in it. Null keys pass. Equal rows get equal
    scores, so ties stay ties; an empty table gives an empty result; other columns do not
    pass.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: tidily(_score_rows(batches, model)), _SCORED.format(kind=kind)).withColumnRenamed("key", key)


def clean(docs: DataFrame, model: Scores, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below one half, with their own columns.

    Scores are those of :func:`score`. A text of any length is scored whole; a null or empty
    text scores as one without tokens; equal rows stay or go together; nulls in other columns
    pass; an empty table gives an empty result.
    """
    keep_batches_small(docs.sparkSession)
    kinds, names = docs.schema, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, segments in _scored(batch.column(names.index(text)), model):
                keep.append(float(np.dot(model.weights, features(n, segments, model))) < 0)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(lambda batches: tidily(run(batches)), kinds)
