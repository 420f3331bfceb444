"""Exact duplicates by two passes over a Bloom filter.

The first pass notes which bits the texts' hashes set more than once; the second sends
through the shuffle only rows all of whose bits were set again, as only these can have a
copy. Every other row passes straight through.

The filter has 16 bits a row, however many rows there are. While it is small it is
broadcast. A larger one stays a table of slices, which the distinct hashes, 8 bytes each,
meet by slice; what is broadcast then is a filter of the repeated hashes alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daytally.llm.common import packed, text_or_empty, tidily, unpacked, written

SLICE_BITS = 1 << 16
BITS_PER_ROW = 16
#: A filter that is broadcast ends at 32 MB. With more than 17 million texts that occur
#: more than once, more rows shuffle; results stay the same.
MAX_BITS = 1 << 28
#: Bits that a task notes before it counts them together with what it has.
RUN = 1 << 20
#: Copies of one text go to tasks of about this many rows.
HOT_ROWS = 1024
_HOT_BUCKETS = 1 << 16


def _bits(h: Column, slices: int) -> tuple[Column, Column, Column]:
    """The slice of the filter that a hash falls in, and its two bits there."""
    low = lambda shift: F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(SLICE_BITS - 1)).cast("int")
    return F.pmod(F.shiftrightunsigned(h, 32), F.lit(slices)).cast("int"), low(0), low(16)


def _own_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often, up to twice, the rows of this task set each bit: one row for each slice."""
    keys, times, run = np.empty(0, np.int64), np.empty(0, np.int64), []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        every, where = np.unique(np.concatenate([keys, *run]), return_inverse=True)
        weights = np.ones(len(where), np.int64)
        weights[: len(times)] = times
        return every, np.minimum(np.bincount(where, weights, len(every)), 2).astype(np.int64)

    for batch in batches:
        run += [batch.column(0).to_numpy().astype(np.int64) * SLICE_BITS + batch.column(i).to_numpy() for i in (1, 2)]
        if sum(map(len, run)) >= max(RUN, len(keys)):  # sorting stays linear in the rows but for a logarithm
            (keys, times), run = merged(), []
    keys, times = merged()
    owner = keys // SLICE_BITS
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    for low, high in zip(starts, [*starts[1:], len(keys)]):
        set_bits = (keys[low:high] % SLICE_BITS).astype("<u2")
        yield pa.RecordBatch.from_pydict(
            {"slice": pa.array([owner[low]], pa.int32()), "bits": pa.array([set_bits.tobytes()], pa.binary()), "times": pa.array([times[low:high].astype(np.uint8).tobytes()], pa.binary())}
        )


def _set_bits(batches: Iterator[pa.RecordBatch], often: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by slice: the bits that were set at least ``often`` times, as a bitmap."""
    current, counts = None, np.zeros(SLICE_BITS, np.uint8)

    def done() -> pa.RecordBatch:
        bitmap = np.packbits(counts >= often, bitorder="little").tobytes()
        return pa.RecordBatch.from_pydict({"slice": pa.array([current], pa.int32()), "bitmap": pa.array([bitmap], pa.binary())})

    for batch in batches:
        for row in batch.to_pylist():
            if row["slice"] != current:
                if current is not None:
                    yield done()
                current, counts = row["slice"], np.zeros(SLICE_BITS, np.uint8)
            at = np.frombuffer(row["bits"], "<u2")
            counts[at] = np.minimum(counts[at] + np.frombuffer(row["times"], np.uint8), 2)
    if current is not None:
        yield done()


def repeat_filter(hashes: DataFrame, slices: int, often: int = 2) -> DataFrame:
    """(slice, bitmap) over a table of one hash a row: ``slices`` bitmaps of 8 KB at most, of
    the bits that were set at least ``often`` times."""
    s, a, b = _bits(F.col("h"), slices)
    own = hashes.select(s.alias("slice"), a.alias("a"), b.alias("b")).mapInArrow(lambda batches: tidily(_own_bits(batches)), "slice int, bits binary, times binary")
    ordered = own.repartition("slice").sortWithinPartitions("slice")
    return ordered.mapInArrow(lambda batches: tidily(_set_bits(batches, often)), "slice int, bitmap binary")


def _slices(rows: int) -> int:
    return max(1, -(-rows * BITS_PER_ROW // SLICE_BITS))


def _is_set(bit: str) -> Column:
    byte = F.conv(F.hex(F.expr(f"substring(bitmap, {bit} div 8 + 1, 1)")), 16, 10).cast("int")
    return F.coalesce(byte.bitwiseAND(F.expr(f"shiftleft(1, {bit} % 8)")) != 0, F.lit(False))


def _tested(rows: DataFrame, bitmaps: DataFrame, slices: int, small: bool) -> DataFrame:
    """``rows`` with ``again``: whether all bits of the hash ``h`` are set."""
    s, a, b = _bits(F.col("h"), slices)
    met = rows.withColumns({"slice": s, "a": a, "b": b}).join(F.broadcast(bitmaps) if small else bitmaps, "slice", "left")
    return met.withColumn("again", _is_set("a") & _is_set("b")).select(*rows.columns, "again")


def possible_copies(hashed: DataFrame) -> DataFrame:
    """``hashed`` with ``again``: true of every row whose hash ``h`` another row has, and of
    few others."""
    hashes = hashed.select("h")
    slices = _slices(hashed.count())
    bitmaps = written(repeat_filter(hashes, slices), "bloom")
    if slices * SLICE_BITS <= MAX_BITS:
        return _tested(hashed, bitmaps, slices, small=True)
    repeated = written(_tested(hashes.distinct(), bitmaps, slices, small=False).filter("again").select("h"), "repeated")
    slices = min(_slices(repeated.count()), max(1, MAX_BITS // SLICE_BITS))
    return _tested(hashed, written(repeat_filter(repeated, slices, often=1), "bloom"), slices, small=True)


def _with_groups(maybe: DataFrame, groups: DataFrame) -> DataFrame:
    """Each row with the group of its text, if that has one: ``maybe`` left join ``groups``.

    A bucket of texts that holds a group of over HOT_ROWS rows is hot. Rows of hot buckets are
    dealt over as many parts as the greatest group there asks for, and each part gets the
    groups. The list of hot buckets has at most 65,536 rows, so it is broadcast."""
    bucket = lambda sha: F.pmod(F.xxhash64(sha), F.lit(_HOT_BUCKETS)).cast("int")
    parts = F.ceil(F.max("group_size") / HOT_ROWS).cast("int").alias("parts")
    hot = written(groups.filter(F.col("group_size") > HOT_ROWS).groupBy(bucket("sha").alias("bucket")).agg(parts), "hot")
    parts = F.coalesce("parts", F.lit(1))
    left = maybe.withColumn("bucket", bucket("sha")).join(F.broadcast(hot), "bucket", "left")
    left = left.withColumn("part", F.pmod(F.xxhash64("row", F.spark_partition_id()), parts).cast("int")).drop("bucket", "parts")
    right = groups.withColumn("bucket", bucket("sha")).join(F.broadcast(hot), "bucket", "left")
    right = right.select(F.col("sha").alias("group_sha"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("group_part"), "group_size", "keep_id", "n_top")
    right = written(right, "dealt")  # of a known size, so that Spark broadcasts few groups instead of sending the texts
    return left.join(right, (F.col("sha") == F.col("group_sha")) & (F.col("part") == F.col("group_part")), "left").drop("group_sha", "group_part", "part")


def _one_of_ties(rows: DataFrame) -> DataFrame:
    """``rows`` with ``kept``, true of one row of each text: the one of the least hash.

    Every part of the rows chooses its own one, and these, one a part and text, are compared
    again, so that many repeats of one row are not sorted by one task."""
    part, own = F.spark_partition_id(), F.xxhash64("row")
    chosen = rows.withColumns({"part": part, "own": own})
    chosen = chosen.withColumn("place", F.row_number().over(Window.partitionBy("sha", "part").orderBy("own")))
    chosen = chosen.withColumn("heat", F.when(F.col("place") == 1, F.lit(-1)).otherwise(F.col("part")))
    last = F.row_number().over(Window.partitionBy("sha", "heat").orderBy("own", "part"))
    return chosen.withColumn("kept", (last == 1) & (F.col("place") == 1))


def mark(docs: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with text_sha256, keep_id, group_size and kept.

    Texts are equal when they are identical; null counts as empty. Of equal texts the row
    with the largest ``order`` stays; a null ``order`` is below all others. If several
    rows share that largest one, exactly one of them stays. ``keep_id`` is the ``order``
    of the row that stays and ``group_size`` the number of equal texts. Texts of any length
    are compared whole, by their SHA-256. An empty table
    gives an empty result. Columns of the input with these names are replaced.
    """
    hashed = packed(docs, o=F.col(order), sha=F.sha2(text_or_empty(text), 256), h=F.xxhash64(text_or_empty(text)))
    tested = possible_copies(hashed)
    maybe = tested.filter("again").select("row", "o", "sha")
    groups = written(
        maybe.groupBy("sha", "o").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("sha")
        .agg(F.sum("n").alias("group_size"), F.max("o").alias("keep_id"), F.max_by("n", F.struct(F.col("o").isNotNull(), "o")).alias("n_top"))
        .filter("group_size > 1"),
        "groups",
    )
    joined = _with_groups(maybe, groups)
    joined = joined.withColumn("top", F.col("group_size").isNull() | F.col("o").eqNullSafe(F.col("keep_id")))
    tied = F.col("top") & (F.coalesce("n_top", F.lit(1)) > 1)
    first = F.col("group_size").isNull()
    columns = [
        "row",
        F.when(first, F.col("o")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("kept"),
        F.col("sha").alias("text_sha256"),
    ]
    parts = [
        tested.filter(~F.col("again")).select("row", F.col("o").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256")),
        joined.filter(~tied).withColumn("kept", F.col("top")).select(*columns),
        _one_of_ties(joined.filter(tied)).select(*columns),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return unpacked(out, "keep_id", "group_size", "kept", "text_sha256")


def deduplicate(docs: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that :func:`mark` keeps, with their own columns, whatever these
    are called. Null and empty texts are equal; texts of any length count whole; of ties and
    repeated rows exactly one stays; an empty table gives an empty result."""
    kept = mark(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("all"), F.col(text).alias("t"), F.col(order).alias("o")), "t", "o")
    return kept.filter("kept").select("all.*")
