"""Passages that documents share, by MinHash bands over paragraphs.

A shared passage may stand in the middle of other text, so a paragraph here is a run of
WINDOW words that begins where the text itself says: at the least hash of each stretch of
places (a stretch is so long that every passage of LONGEST_APART words and more holds a
whole paragraph). Equal passages then have equal paragraphs wherever they stand.

Paragraphs with equal words are one class. Classes that collide in a band, and whose bitmaps
of shingles differ in no more bits than those of similar ones can, are compared by the exact Jaccard similarity of their word shingles, and similar ones are clustered by
components. Of a cluster the paragraphs of the document with the smallest id stay. Runs of
paragraphs make passages; their ends, and all of one that its paragraphs do not prove to be
long, are held against all runs of that length around the paragraph.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daytally.llm.common import gathered, tidily
from daytally.llm.components import components
from daytally.llm.words import hashed_words, mix

WORDS = 5
SIMILARITY = 0.8
WINDOW = 25
#: Passages of at least so many words are found.
PASSAGE = 51
STRETCH = PASSAGE - WINDOW
RECALL = 0.95
#: MinHashes of a band, and bands that similar paragraphs collide in with this probability. Of
#: two, so that paragraphs which share a common phrase alone seldom meet.
DEPTH = 2
BANDS = ceil(log(1 - RECALL) / log(1 - SIMILARITY**DEPTH))
#: Shingles that two similar paragraphs do not share, at most.
APART = int(2 * (WINDOW - WORDS + 1) * (1 - SIMILARITY) / (1 + SIMILARITY))
#: All pairs of a band up to this length are looked at; a longer one is split first,
SHORT_LIST = 16
#: in memory up to this length, and by a shuffle beyond it.
HELD_LIST = 1 << 16
ROWS = 1 << 17
#: Bits of a filter sent with a task: 2 MB. More keys let more rows pass; joins are exact.
FILTER_BITS = 1 << 24
_PAGE = 32768

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]

_TURNS = mix(np.arange(1, DEPTH * BANDS + 1, dtype=np.uint64)) | np.uint64(1)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` values in a row."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def _runs(hashes: np.ndarray, k: int, step: np.uint64) -> np.ndarray:
    """A hash of every ``k`` words in a row."""
    total = hashes[: len(hashes) - k + 1].copy()
    for i in range(1, k):
        total *= step
        total += hashes[i : len(hashes) - k + 1 + i]
    return mix(total)


def _anchors(ranks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of texts whose places are ``ranks[starts[i]:ends[i]]``: the number of the text and the
    place of all that are least in some stretch; in texts of one stretch or less, the first."""
    lengths = ends - starts
    short, long = np.flatnonzero((lengths > 0) & (lengths <= STRETCH)), np.flatnonzero(lengths > STRETCH)
    first = np.array([starts[i] + ranks[starts[i] : ends[i]].argmin() for i in short], np.int64)
    if not len(long):
        return short, first
    # the texts in a row, with zeros between, so that no stretch over two texts counts
    before = np.cumsum(lengths[long] + STRETCH) - lengths[long]
    texts = np.repeat(long, lengths[long])
    shift = np.repeat(before - starts[long], lengths[long])
    places = np.arange(len(texts)) + np.repeat(starts[long] - (np.cumsum(lengths[long]) - lengths[long]), lengths[long])
    row = np.zeros(before[-1] + lengths[long[-1]] + STRETCH, np.uint64)
    row[places + shift] = ranks[places]
    padded = np.concatenate([np.zeros(STRETCH - 1, np.uint64), _sliding(row, STRETCH, np.minimum), np.zeros(STRETCH - 1, np.uint64)])
    least = (_sliding(padded, STRETCH, np.maximum) == row)[places + shift]
    text, place = np.concatenate([short, texts[least]]), np.concatenate([first, places[least]])
    order = np.argsort(place, kind="stable")
    return text[order], place[order]


def _thinned(text: np.ndarray, place: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Which paragraphs stay: of equal ones in a row, in repetitive text, the first, the last
    and enough between them that no word and no stretch is left without one."""
    same = (kind[1:] == kind[:-1]) & (text[1:] == text[:-1]) & (np.diff(place) <= WINDOW)
    inner = np.concatenate([[False], same[1:] & same[:-1], [False]])[: len(kind)]
    keep, last = np.ones(len(kind), bool), 0
    for i in np.flatnonzero(inner):
        if not inner[i - 1]:
            last = place[i - 1]
        if place[i + 1] - last <= WINDOW:
            keep[i] = False
        else:
            last = place[i]
    return keep


def _band(own: np.ndarray, number: int) -> np.ndarray:
    """A band's key: the least of the shingles under each of its DEPTH hashes."""
    key = np.full(len(own), number, np.uint64)
    for turn in _TURNS[number * DEPTH : (number + 1) * DEPTH]:
        key = mix(key * _ODD[2] + (own * turn).min(axis=1))
    return key


def _paragraphs(column: pa.Array) -> Iterator[tuple]:
    """Of runs of texts: the first text's number, then of each paragraph its text, place and
    class, then the shingles at all places, all word hashes and the texts' bounds in them."""
    for first, _, hashes, bounds in hashed_words(column):
        if len(hashes) < WINDOW:
            continue
        shingles = _runs(hashes, WORDS, _ODD[0])
        ranks = shingles * _ODD[1]
        bounds = np.asarray(bounds)
        text, place = _anchors(ranks, bounds[:-1], bounds[1:] - WINDOW + 1)
        if not len(text):
            continue
        kind = mix(reduce(lambda x, y: x * _ODD[0] + y, [shingles[place + j] for j in range(0, WINDOW - WORDS + 1, WORDS)]))
        keep = _thinned(text, place, kind)
        text, place, kind = text[keep], place[keep], kind[keep]
        yield first, text, place, kind, shingles, hashes, bounds


def _own(shingles: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The shingles of the paragraphs at these places, a row for each."""
    return shingles[place[:, None] + np.arange(WINDOW - WORDS + 1)]


def _marks(own: np.ndarray) -> np.ndarray:
    """64 bits of each row of shingles: those of similar paragraphs differ in APART at most."""
    return np.bitwise_or.reduce(np.uint64(1) << (own * _ODD[4] >> np.uint64(58)), axis=1)


def _column(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, id, start) of the paragraphs."""
    for batch in batches:
        for first, text, place, kind, _, _, bounds in _paragraphs(batch.column(1)):
            ids = batch.column(0).take(pa.array(first + text))
            yield pa.RecordBatch.from_arrays([_column(kind), ids, pa.array(place - bounds[text])], names=["class", "id", "start"])


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, class, marks), each once in about ROWS rows, so that a passage that very many
    documents have is sent on a few times only."""
    held: list[list[np.ndarray]] = []

    def distinct() -> pa.RecordBatch:
        band, kind, marks = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((kind, band))
        band, kind, marks = band[order], kind[order], marks[order]
        new = np.concatenate([[True], (band[1:] != band[:-1]) | (kind[1:] != kind[:-1])])
        return pa.RecordBatch.from_arrays([_column(x[new]) for x in (band, kind, marks)], names=["band", "class", "marks"])

    for batch in batches:
        for _, _, place, kind, shingles, _, _ in _paragraphs(batch.column(1)):
            own = _own(shingles, place)
            bands = np.concatenate([_band(own, i) for i in range(BANDS)])
            held.append([bands, np.tile(kind, BANDS), np.tile(_marks(own), BANDS)])
            if sum(len(x[0]) for x in held) >= ROWS:
                yield distinct()
                held = []
    if held:
        yield distinct()


def _with_shingles(batches: Iterator[pa.RecordBatch], wanted: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, text, place, kind, shingles, _, _ in _paragraphs(batch.column(1)):
            use = np.flatnonzero(_may(kind, wanted))
            ids = batch.column(0).take(pa.array(first + text[use]))
            low = np.ascontiguousarray(_own(shingles, place[use]).astype(np.uint32))
            sets = pa.Array.from_buffers(pa.binary(4 * low.shape[1]), len(low), [None, pa.py_buffer(low)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([_column(kind[use]), ids, sets], names=["class", "id", "shingles"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (a, b, x, y) whose sets of shingles, 32 bits of each, are similar; without these."""
    for batch in batches:
        if not len(batch):
            continue
        x, y = (np.sort(np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(len(batch), -1), axis=1) for i in (2, 3))
        again_x, again_y = (np.pad(v[:, 1:] == v[:, :-1], ((0, 0), (1, 0))) for v in (x, y))
        shared = np.zeros(len(x), np.int64)
        for i in range(x.shape[1]):
            shared += (y == x[:, i, None]).any(axis=1) & ~again_x[:, i]
        union = x.shape[1] + y.shape[1] - again_x.sum(axis=1) - again_y.sum(axis=1) - shared
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(shared >= SIMILARITY * union))


def _around(batches: Iterator[pa.RecordBatch], wanted: bytes, documents: bytes) -> Iterator[pa.RecordBatch]:
    """(run, id, start): every run of PASSAGE words that holds a wanted paragraph, in the
    documents that may have any to settle."""
    for batch in batches:
        batch = batch.filter(pa.array(_may(batch.column(0).to_numpy().view(np.uint64), documents)))
        for first, text, place, kind, _, hashes, bounds in _paragraphs(batch.column(1)):
            use = np.flatnonzero(_may(kind, wanted))
            if not len(use) or len(hashes) < PASSAGE:
                continue
            runs = _runs(hashes, PASSAGE, _ODD[3])
            start = place[use][:, None] - np.arange(STRETCH + 1)
            own = np.broadcast_to(text[use][:, None], start.shape)
            fits = (start >= bounds[own]) & (start + PASSAGE <= bounds[own + 1])
            start, at = np.unique(start[fits], return_index=True)
            own = own[fits][at]
            ids = batch.column(0).take(pa.array(first + own))
            yield pa.RecordBatch.from_arrays([_column(runs[start]), ids, pa.array(start - bounds[own])], names=["run", "id", "start"])


def _filter(keys: DataFrame, key: str) -> bytes:
    """A bitmap of the low bits of ``keys``: at most FILTER_BITS / 8 bytes on the driver."""
    slot = F.col(key).bitwiseAND(F.lit(FILTER_BITS - 1))
    pages = keys.select(F.floor(slot / _PAGE).cast("int").alias("page"), (slot % _PAGE).alias("bit"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in pages.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        bits[row["page"] * _PAGE // 8 :][: _PAGE // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits.tobytes()


def _may(keys: np.ndarray, wanted: bytes) -> np.ndarray:
    slot = (keys & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    return (np.frombuffer(wanted, np.uint8)[slot >> 3] >> (slot & 7) & 1).astype(bool)


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Runs of whole lists from rows (list, class, marks) sorted by the first two, each once."""
    held: list[list[np.ndarray]] = []
    count = 0

    def distinct(rows: list[np.ndarray]) -> list[np.ndarray]:
        new = np.concatenate([[True], (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])])
        return [c[new] for c in rows]

    for batch in batches:
        if not len(batch):
            continue
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        count += len(batch)
        if count < ROWS or held[0][0][0] == held[-1][0][-1]:
            continue
        rows = [np.concatenate(x) for x in zip(*held)]
        last = int(np.flatnonzero(rows[0] != rows[0][-1])[-1]) + 1
        yield distinct([c[:last] for c in rows])
        held, count = [[c[last:] for c in rows]], len(rows[0]) - last
    if count:
        yield distinct([np.concatenate(x) for x in zip(*held)])


_PAIRED = "a long, b long, marks long"


_WIDTH = -(-64 // (APART + 1))
_MASK = np.uint64((1 << _WIDTH) - 1)


def _pairs(lists: np.ndarray, kind: np.ndarray, marks: np.ndarray, part: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """All pairs within lists whose marks do not rule similarity out; without marks. Of lists
    that hold a ``part`` of a longer one, those that no list of an earlier part gives."""
    found, count, lag, at, bits = [], 0, 0, np.arange(len(lists)), marks.view(np.uint64)
    while True:
        lag += 1
        at = at[: np.searchsorted(at, len(lists) - lag)]
        at = at[lists[at + lag] == lists[at]]
        if len(at):
            unequal = bits[at] ^ bits[at + lag]
            close = np.bitwise_count(unequal) <= APART
            use, unequal = at[close], unequal[close]
            if part is not None:
                new = np.ones(len(use), bool)
                for earlier in range(APART):
                    new &= (part[use] <= earlier) | ((unequal >> np.uint64(earlier * _WIDTH) & _MASK) != 0)
                use = use[new]
            found.append((kind[use], kind[use + lag]))
            count += len(use)
        if found and (count >= ROWS or not len(at)):
            a, b = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], names=["a", "b", "marks"])
            found, count = [], 0
        if not len(at):
            return


def _parts(band: np.ndarray, kind: np.ndarray, marks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows (list, class, marks) of the shorter lists that bands are split into: marks that
    differ in APART bits at most are equal in one of APART + 1 parts, so that similar classes
    still meet. The low bits of a list are the number of its part."""
    bits = marks.view(np.uint64)
    for part in range(APART + 1):
        own = bits >> np.uint64(part * _WIDTH) & _MASK
        yield (mix(band.view(np.uint64) * _ODD[0] + own) & ~np.uint64(7) | np.uint64(part)).view(np.int64), kind, marks


def _collisions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of classes from rows (band, class, marks): all pairs of a short list, and those
    of the parts of a longer one. One too long for that gives rows (list, class, marks)."""
    for band, kind, marks in _whole_lists(batches):
        first = np.concatenate([[True], band[1:] != band[:-1]])
        lengths = np.diff(np.append(np.flatnonzero(first), len(band)))
        length = np.repeat(lengths, lengths)
        short, far = length <= SHORT_LIST, length > HELD_LIST
        held = ~short & ~far
        yield from _pairs(band[short], kind[short], marks[short])
        if held.any():
            for lists, classes, own in _parts(band[held], kind[held], marks[held]):
                order = np.lexsort((classes, lists))
                yield from _pairs(lists[order], classes[order], own[order], lists[order] & 7)
        if far.any():
            for rows in _parts(band[far], kind[far], marks[far]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=["a", "b", "marks"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lists, kind, marks in _whole_lists(batches):
        yield from _pairs(lists, kind, marks, lists & 7)


def _candidates(rows: DataFrame) -> DataFrame:
    """(a, b): the pairs of classes that collide in a band and may be similar."""
    banded = rows.mapInArrow(lambda batches: tidily(_banded(batches)), "band long, class long, marks long").repartition("band").sortWithinPartitions("band", "class")
    found = gathered(banded.mapInArrow(lambda batches: tidily(_collisions(batches)), _PAIRED), "collisions")
    split = found.filter("marks IS NOT NULL").repartition("a").sortWithinPartitions("a", "b")
    met = split.mapInArrow(lambda batches: tidily(_met(batches)), _PAIRED)
    return found.filter("marks IS NULL").unionByName(met).select("a", "b").distinct()


def _similar(pairs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The similar ones of ``pairs`` of classes, and (class, low, high): the smallest and
    the largest document of each class that occurs in a pair."""
    classes = gathered(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "classes")
    wanted = _filter(classes, "class")
    found = rows.mapInArrow(lambda batches: tidily(_with_shingles(batches, wanted)), "class long, id long, shingles binary")
    found = found.join(classes, "class", "left_semi").groupBy("class")
    sets = gathered(found.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.first("shingles").alias("shingles")), "shingles")
    of = lambda end, name: sets.select(F.col("class").alias(end), F.col("shingles").alias(name))
    both = pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").select("a", "b", "x", "y")
    links = both.mapInArrow(lambda batches: tidily(_alike(batches)), "a long, b long")
    return gathered(links, "similar"), sets.select("class", "low", "high")


def occurrences(rows: DataFrame) -> DataFrame:
    """(class, id, start): all paragraphs of ``rows`` (id, text)."""
    return gathered(rows.mapInArrow(lambda batches: tidily(_occurrences(batches)), "class long, id long, start long"), "occurrences")


def clusters(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(class, cluster, keeper) of the classes that more than one document holds, by
    themselves or with similar ones; ``keeper`` is the smallest document of the cluster.
    ``found`` are the :func:`occurrences` of ``rows``."""
    counted = found.groupBy("class")
    repeated = gathered(counted.agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high"), "repeated")
    pairs = gathered(_candidates(rows), "pairs")
    links, of_pairs = _similar(pairs, rows)
    labels = gathered(components(links), "labels").withColumnRenamed("node", "class")
    near = labels.join(of_pairs, "class")
    spread = near.groupBy("component").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high")
    joined = labels.join(spread, "component").select("class", F.col("component").alias("cluster"), F.col("low").alias("keeper"))
    alone = repeated.join(labels.select("class"), "class", "left_anti").select("class", F.col("class").alias("cluster"), F.col("low").alias("keeper"))
    return gathered(alone.unionByName(joined), "clusters")


def _numbered(spans: DataFrame) -> DataFrame:
    """Spans (id, start, end, ...) with the number of their island: those that touch are one."""
    order = Window.partitionBy("id").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)
    island = F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return spans.withColumn("new", new).withColumn("island", island).drop("new")


def _islands(spans: DataFrame, *more: Column) -> DataFrame:
    """Spans (id, start, end, ...) that touch, as one."""
    return _numbered(spans).groupBy("id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), *more)


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))


def repeated_spans(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(id, start, end, cluster, keeper): the pieces of shared passages, in words."""
    rows = _rows(docs, text, key)
    found = occurrences(rows)
    known = clusters(rows, found)
    pieces = found.join(known, "class").withColumn("end", F.col("start") + WINDOW)
    ends = Window.partitionBy("id", "island")
    inside = _numbered(pieces).withColumns({"low": F.min("start").over(ends), "high": F.max("end").over(ends)})
    inside = gathered(inside.drop("island"), "pieces")
    proven = inside.filter(F.col("high") - F.col("low") >= PASSAGE).select("id", "start", "end", "cluster", "keeper")
    at_end = (F.col("start") == F.col("low")) | (F.col("end") == F.col("high"))
    open_ = gathered(inside.filter(at_end | (F.col("high") - F.col("low") < PASSAGE)).select("id", "start", "class", "cluster", "keeper"), "open")
    open_classes = _filter(open_.select("class").distinct(), "class")
    documents = _filter(open_.select("id").distinct(), "id")
    runs = gathered(rows.mapInArrow(lambda batches: tidily(_around(batches, open_classes, documents)), "run long, id long, start long"), "runs")
    again = runs.groupBy("run").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("run")
    long_runs = runs.join(again, "run", "left_semi").select("id", F.col("start").alias("run_start"))
    holds = F.col("start").between(F.col("run_start"), F.col("run_start") + STRETCH)
    settled = open_.join(long_runs, "id").filter(holds).groupBy("id", "start", "cluster", "keeper")
    settled = settled.agg(F.min("run_start").alias("from"), (F.max("run_start") + PASSAGE).alias("end"))
    return proven.unionByName(settled.select("id", F.col("from").alias("start"), "end", "cluster", "keeper"))


def passages(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row for each passage of over 50 words that another document shares, whole or
    nearly: (key, start, end, n_words, cluster, first_doc, removed).

    ``start`` and ``end`` count words from 0, ``first_doc`` is the smallest document that
    holds a part of it, and ``removed`` tells whether any of it goes since an earlier
    document keeps it. Documents that share nothing have no row, nor have null, empty and
    short texts; texts of any length are searched whole; rows with a null key take no part;
    repeated rows of one key are one document, and equal texts share all of theirs. An empty table gives an empty result; other columns do not pass.
    """
    spans = repeated_spans(docs, text, key)
    more = [F.min("cluster").alias("cluster"), F.min("keeper").alias("first_doc"), F.max(F.col("keeper") != F.col("id")).alias("removed")]
    out = _islands(spans, *more)
    return out.select(F.col("id").alias(key), "start", "end", (F.col("end") - F.col("start")).alias("n_words"), "cluster", "first_doc", "removed")


_WORD = rb"[^\x20\x09-\x0D]+"


def _without(text: str, spans: list) -> str:
    """The text without the words of the spans, in code points as they were otherwise."""
    gone = {i for s in spans if s["gone"] for i in range(s["start"], s["end"])} - {i for s in spans if not s["gone"] for i in range(s["start"], s["end"])}
    raw, out, at = text.encode(), [], 0
    for i, word in enumerate(re.finditer(_WORD, raw)):
        if i in gone:
            out.append(raw[at : word.start()])
            at = word.end()
    return b"".join([*out, raw[at:]]).decode()


def remove(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with each shared passage cut out of all documents but the one that keeps
    it; white space and other columns stay. A passage that a document keeps for others
    stays even where it overlaps one that goes. Null, empty and short texts and rows with a
    null key pass as they are; texts of any length are cut whole; repeated rows of one key are
    cut alike; an empty table gives an empty result."""
    spans = repeated_spans(docs, text, key).groupBy("id").agg(
        F.collect_set(F.struct("start", "end", (F.col("keeper") != F.col("id")).alias("gone"))).alias("spans")
    )
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(key).alias("k"), F.col(text).alias("t"))
    joined = packed.join(spans, F.col("k") == F.col("id"), "left").select("row", "t", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None or not s else _without(t, s) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "t"])

    done = joined.mapInArrow(cut, joined.select("row", "t").schema)
    return done.select(*(F.col("t").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
