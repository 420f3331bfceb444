"""Nearest neighbours by a join of blocks: products of 8-bit codes, then exact distances.

Vectors are packed into blocks. For a block of queries and one of candidates, one matrix
product of the codes gives all distances, each with a bound of its error; only pairs that
may be among the nearest are computed again from the vectors themselves. A heap for each
query keeps the nearest of a task's tiles, and the heaps are merged. The answer is exact.

Blocks of candidates never shuffle. Blocks of queries, in groups of at most 16 MB, go to
all tasks, which read the candidates from their written table once a group.

Equal vectors are one candidate with its smallest ids, and one query, so that a vector
that very many rows share costs no more than another.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daytally.llm.common import written
from daytally.session import new_folder

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 2048
#: Bytes of the blocks of queries that are broadcast at a time (one block, if it is greater).
GROUP_BYTES = 16 << 20
#: Rounding of the bounds themselves, relative to the vectors' lengths.
ROUNDING = 1e-6

_PARTS = [("codes", np.int8), ("scale", np.float64), ("norm", np.float64), ("error", np.float64), ("vectors", np.float64)]
_BLOCK = pa.schema([("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("least", pa.binary()), *((n, pa.binary()) for n, _ in _PARTS)])
_BLOCK_TYPE = "dim int, n int, ids binary, least binary, " + ", ".join(f"{n} binary" for n, _ in _PARTS)


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components present and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """8-bit codes and scale of each row, and of what they stand for the squared length
    and the distance from the row."""
    scale = np.abs(vectors).max(axis=1) / 127
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    near = codes * scale[:, None]
    return codes, scale, (near * near).sum(axis=1), np.sqrt(((vectors - near) ** 2).sum(axis=1))


def _packed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows (class, least id, vector) as blocks of one dimension of up to ``size`` rows."""
    for batch in batches:
        lengths = np.diff(batch.column(2).offsets.to_numpy())
        for dim in np.unique(lengths):
            own = batch.filter(pa.array(lengths == dim))
            for low in range(0, len(own), size):
                some = own.slice(low, size)
                vectors = some.column(2).flatten().to_numpy().reshape(len(some), dim)
                values = [*quantised(vectors), vectors]
                row = {"dim": int(dim), "n": len(some), "ids": some.column(0).to_numpy().tobytes(), "least": some.column(1).to_numpy().tobytes()}
                row |= {name: v.astype(kind).tobytes() for (name, kind), v in zip(_PARTS, values)}
                yield pa.RecordBatch.from_pylist([row], _BLOCK)


def _opened(row: dict) -> dict:
    out = {name: np.frombuffer(row[name], kind) for name, kind in [("ids", np.int64), ("least", np.int64), *_PARTS]}
    for name in ("codes", "vectors"):
        out[name] = out[name].reshape(-1, row["dim"])
    return out | {"dim": row["dim"]}


def exact_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows in double precision, summed component by component."""
    total = np.zeros(len(x))
    for i in range(x.shape[1]):
        d = x[:, i] - y[:, i]
        total += d * d
    return np.sqrt(total)


def _tile(q: dict, c: dict, keep: int, heaps: list[list[tuple[float, int, int]]]) -> None:
    """Put the candidates of ``c`` that may be among the ``keep`` nearest into the heaps
    of the queries of ``q``: (-distance, -least id, -class), the worst on top."""
    kind = np.float32 if q["codes"].shape[1] <= 1024 else np.float64  # products of codes stay exact
    codes = c["codes"].astype(kind).T
    for low in range(0, len(q["ids"]), 256):
        s = slice(low, low + 256)
        product = (q["codes"][s].astype(kind) @ codes).astype(np.float64)
        product *= -2 * q["scale"][s, None] * c["scale"]
        product += q["norm"][s, None] + c["norm"]
        near = np.sqrt(np.maximum(product, 0))
        # rounding in the squares matters most where they cancel: a bound on its root
        room = q["error"][s, None] + c["error"] + ROUNDING * (np.sqrt(q["norm"][s, None]) + np.sqrt(c["norm"])) * 10
        high = near + room
        limit = np.full(len(near), np.inf)
        if high.shape[1] > keep:
            limit = np.partition(high, keep - 1, axis=1)[:, keep - 1]
        worst = np.array([-h[0][0] if len(h) == keep else np.inf for h in heaps[s]])
        i, j = np.nonzero(near - room <= np.minimum(limit, worst)[:, None])
        distances = exact_distances(q["vectors"][s][i], c["vectors"][j])
        for row, d, least, cid in zip((i + low).tolist(), distances.tolist(), c["least"][j].tolist(), c["ids"][j].tolist()):
            heap, item = heaps[row], (-d, -least, -cid)
            if len(heap) < keep:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)


def _tiles(batches: Iterator[pa.RecordBatch], group: Broadcast, keep: int) -> Iterator[pa.RecordBatch]:
    """A task's blocks of candidates against all blocks of queries of the group: the nearest
    of each query."""
    asked = [(q, [[] for _ in q["ids"]]) for q in map(_opened, group.value)]
    for batch in batches:
        for start in range(len(batch)):
            c = _opened(batch.slice(start, 1).to_pylist()[0])
            for q, heaps in asked:
                if q["dim"] == c["dim"]:
                    _tile(q, c, keep, heaps)
    for q, heaps in asked:
        rows = [(int(i), -cid, -least, -d) for i, heap in zip(q["ids"], heaps) for d, least, cid in heap]
        columns = [list(x) for x in zip(*rows)] or [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["q", "c", "least", "distance"])


def _groups(blocks: DataFrame) -> list[tuple[int, int]]:
    """Ranges of block numbers whose blocks have GROUP_BYTES or less together. The driver
    gets two numbers a block, that is for every QUERY_BLOCK queries."""
    sizes = blocks.select("block", F.expr("octet_length(codes) + octet_length(vectors) + 40 * n").alias("size")).orderBy("block")
    out, held = [], 0
    for block, size in sizes.toLocalIterator():
        if out and held + size <= GROUP_BYTES:
            out[-1], held = (out[-1][0], block), held + size
        else:
            out, held = [*out, (block, block)], size
    return out


def _met(queries: DataFrame, candidates: DataFrame, keep: int) -> DataFrame:
    """(q, c, distance): the ``keep`` nearest classes of each query class."""
    spark = queries.sparkSession
    root = new_folder(spark, "nearest")
    best = F.row_number().over(Window.partitionBy("q").orderBy("distance", "least"))
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # fewer tasks send fewer heaps
    for number, (low, high) in enumerate(_groups(queries) or [(0, -1)]):
        rows = queries.filter(F.col("block").between(low, high)).collect()
        group = spark.sparkContext.broadcast([r.asDict() for r in rows])
        found = candidates.coalesce(tasks).mapInArrow(partial(_tiles, group=group, keep=keep), "q long, c long, least long, distance double")
        found.withColumn("place", best).filter(F.col("place") <= keep).select("q", "c", "distance").write.parquet(f"{root}/group={number}")
        group.unpersist()
    return spark.read.schema("q long, c long, distance double").parquet(root)


def _classes(rows: DataFrame, keep: int) -> DataFrame:
    """(class, least, ids, vector): each distinct vector with its ``keep`` smallest ids.

    The window keeps no more than that of a vector on each side of the shuffle."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    first = rows.distinct().withColumn("place", place).filter(F.col("place") <= keep)
    grouped = first.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return written(grouped.select(F.monotonically_increasing_id().alias("class"), F.col("ids")[0].alias("least"), "ids", "vector"), "classes")


def nearest(rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of each query row, by Euclidean distance on the vectors.

    (query_id, rank, vec_id, score): rank from 1, nearest first, ties to the smaller key;
    all candidates if there are fewer. ``is_query`` is a condition on column ``id``, the
    key. Null keys and vectors that are null, zero, or hold null or non-finite components
    take no part; vectors of another length are no candidates; a row that is repeated
    counts once, and no row with the query's own key is a candidate. An empty table gives
    an empty result.
    """
    as_double = F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0))  # no negative zero
    usables = rows.filter(usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), as_double.alias("vector")).filter("id IS NOT NULL")
    keep = k + 1  # a class of the query's own id alone may be among the nearest
    classes = _classes(usables, keep)
    asked = usables.filter(is_query).distinct().join(classes.select("class", "vector"), "vector").select(F.col("id").alias("query_id"), F.col("class").alias("q"))
    asked = written(asked, "asked")

    def packed(of: DataFrame, size: int, side: str) -> DataFrame:
        blocks = of.select("class", "least", "vector").mapInArrow(lambda batches: _packed(batches, size), _BLOCK_TYPE)
        return written(blocks.withColumn("block", F.monotonically_increasing_id()), f"{side}_blocks")

    chosen = classes.join(asked.select(F.col("q").alias("class")).distinct(), "class", "left_semi")
    queries, candidates = packed(chosen.repartition(max(1, asked.count() // QUERY_BLOCK // 8)), QUERY_BLOCK, "query"), packed(classes, CANDIDATE_BLOCK, "candidate")
    merged = _met(queries, candidates, keep)
    answers = merged.join(classes.select(F.col("class").alias("c"), "ids"), "c").select("q", "distance", F.explode("ids").alias("id"))
    first = F.row_number().over(Window.partitionBy("q").orderBy("distance", "id"))
    answers = answers.withColumn("place", first).filter(F.col("place") <= keep).select("q", "distance", "id")
    ranked = asked.join(answers, "q").filter("id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    top = ranked.withColumn("rank", rank).filter(F.col("rank") <= k)
    return top.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), F.col("distance").alias("score"))
