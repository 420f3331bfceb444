"""What the operators share: tables, scratch tables, row packing and seeded hashes."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daytally.session import new_folder, settings

#: Batches between Spark and Python while a table is written: what a task holds of texts. So
#: small that the JVM gives the same native memory to one after the other.
ARROW_BYTES = "2m"

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Spark removes the shuffle files of a query when it ends, not when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Rows that a task decodes of a file at a time. Spark's own 4,096 whole texts are arrays of
#: megabytes, which grow by doubling and each need free memory in one piece: the heap grows for them.
READER_ROWS = "256"

_READER_ROWS = "spark.sql.parquet.columnarReaderBatchSize"

#: Files of a gathered table for each core, and at least.
FILES_A_CORE, LEAST_FILES = 4, 32

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession):
    """For the time of a block, batches of ARROW_BYTES between Spark and Python."""
    return settings(spark, {_BATCH_BYTES: ARROW_BYTES})


def keep_batches_small(spark: SparkSession) -> None:
    """Batches of ARROW_BYTES from now on, for results that the caller writes; a session with
    a size of its own keeps it."""
    if _BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(_BATCH_BYTES, ARROW_BYTES)


def keep_reads_small(spark: SparkSession) -> None:
    """READER_ROWS rows at a time from files from now on, for results that the caller writes;
    a session with a size of its own keeps it."""
    if _READER_ROWS not in spark.conf.getAll:
        spark.conf.set(_READER_ROWS, READER_ROWS)


def tidily(batches: Iterator) -> Iterator:
    """The same batches; then the memory that a Python worker no longer needs goes back, as
    it stays for tasks of other kinds."""
    try:
        yield from batches
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library may have none
        if trim is not None:
            trim(0)


def tokenizer(path: str) -> Tokenizer:
    """The tokenizers library with one thread: Spark runs a task on each core, and threads beside
    them wait for one another, which costs as much CPU time as the work itself."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, and there for every
    executor, so that no later loss of an executor computes it again. The shuffles that made it
    are not needed then, and their files go at once."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    with small_batches(spark), settings(spark, {_CLEANUP: "true"}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, name: str) -> DataFrame:
    """As :func:`written`, in a few files for each core however many parts ``df`` has. An operator
    with many small tables would else make thousands of files, and for each one on a local disk
    the executor starts processes that set its permissions."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return written(df.coalesce(max(LEAST_FILES, FILES_A_CORE * cores)), name)


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """Every column of ``df`` in one struct ``row``, beside ``columns``: names of the
    input cannot clash with an operator's own."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), *(c.alias(n) for n, c in columns.items()))


def unpacked(df: DataFrame, *columns: str) -> DataFrame:
    """The columns of ``row``, then ``columns``; of two with one name the latter stays."""
    own = [f for f in df.schema["row"].dataType.names if f not in columns]
    return df.select(*(F.col("row").getField(f).alias(f) for f in own), *columns)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def unit(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on ``key`` and ``seed`` alone: 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def fold(key: Column, folds: int) -> Column:
    """``crc32`` of the key as text, modulo ``folds``; null keys count as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds


#: Bits of a broadcast filter of keys: 2 MB. With more keys than it tells apart, more rows
#: pass it; the join that follows is exact.
FILTER_BITS = 1 << 24
_PAGE = 32768


def _slot(key: str) -> tuple[Column, Column]:
    slot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    return F.floor(slot / _PAGE).cast("int"), slot % _PAGE


def maybe_in(rows: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among ``keys``: a cheap step
    before a join that shuffles long texts."""
    page, bit = _slot(name)
    pages = keys.groupBy(page.alias("_page")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    page, bit = _slot(key)
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftleft(1, cast(_bit % 8 AS int))").bitwiseAND(byte) != 0
    tested = rows.withColumns({"_page": page, "_bit": bit}).join(F.broadcast(pages), "_page")
    return tested.filter(is_set).select(*rows.columns)
