"""Vectors as short codes: each is cut into parts, each part named by its nearest codebook entry.

Components become integers, and all sums and distances are exact. Codebooks are refined by
rounds of assigning and averaging. Rows are held in chunks, and over each part of a chunk's
vectors stands a tree of balls, built once from the middle out: about sqrt(n) anchors, each
new one the point farthest from its anchor, each point with its nearest anchor; balls of
anchors merged in pairs upwards, the pair with the smallest common ball first; and each
anchor split into anchors of its own downwards. A ball keeps the sum and the number of its
points. In a round each ball inherits the entries that may be nearest to any point of the
ball above it and drops those that are farther from all its points than another is. A ball
left with one entry is owned by it: its sum and number count as a whole. Only points of the
lowest balls with several entries left are compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm.common import tidily, written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors of a chunk, whose trees are built together.
CHUNK = 1024
#: Pairs of a point and an entry compared at a time; bounds memory.
PAIRS = 1 << 18
_FAR = np.iinfo(np.int64).max


@dataclass
class Forest:
    """The trees of all parts of a chunk. Nodes of all trees are in one list, a part's root at
    the place of the part's number, children side by side after it. ``order`` has each part's
    points in the order of the leaves, so that every node is a range of it."""

    order: np.ndarray  # (parts, n)
    part: np.ndarray  # of each node: its part,
    low: np.ndarray  # the range of its points
    high: np.ndarray
    first: np.ndarray  # and of its children, none for leaves
    last: np.ndarray
    radius: np.ndarray
    total: np.ndarray  # (nodes, width of a part): the sum of its points

    KINDS = (np.int32, np.int32, np.int32, np.int32, np.int32, np.int32, np.float64, np.int64)

    def packed(self) -> list[bytes]:
        return [np.ascontiguousarray(a, k).tobytes() for a, k in zip(astuple(self), self.KINDS)]

    @classmethod
    def unpacked(cls, data: list[bytes], parts: int) -> Forest:
        arrays = [np.frombuffer(b, k) for b, k in zip(data, cls.KINDS)]
        return cls(arrays[0].reshape(parts, -1), *arrays[1:-1], arrays[-1].reshape(len(arrays[1]), -1))


def _anchors(points: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of points in runs: each point's anchor, numbered within its run of n, of about sqrt(n)."""
    run = np.repeat(np.arange(len(counts)), counts)
    owner = np.zeros(len(points), np.int32)
    wanted = np.ceil(np.sqrt(counts)).astype(np.int64)
    from_anchor = ((points - points[starts][run]) ** 2).sum(1)
    for number in range(1, int(wanted.max(initial=0))):
        active = wanted[run] > number
        at = np.flatnonzero(active)
        own = run[at]
        begins = np.flatnonzero(np.diff(own, prepend=-1))
        most = np.maximum.reduceat(from_anchor[at], begins)
        farthest = np.flatnonzero(from_anchor[at] == np.repeat(most, np.diff(begins, append=len(at))))
        new = farthest[np.unique(own[farthest], return_index=True)[1]]
        d = ((points[at] - np.repeat(points[at[new]], np.diff(begins, append=len(at)), 0)) ** 2).sum(1)
        nearer = at[d < from_anchor[at]]
        owner[nearer] = number
        from_anchor[at] = np.minimum(from_anchor[at], d)
    return owner


def _merged(centers: np.ndarray, counts: np.ndarray, radii: np.ndarray) -> list[tuple[int, int]]:
    """Which balls are merged, two at a time; the k-th merge makes ball ``len(counts) + k``."""
    n = len(counts)
    centers, radii = centers.copy(), radii.copy()
    weights, name = counts.astype(float), np.arange(n)
    common = np.sqrt(((centers[:, None] - centers) ** 2).sum(2)) + radii[:, None] + radii
    np.fill_diagonal(common, np.inf)
    pairs = []
    for made in range(n, 2 * n - 1):
        a, b = sorted(divmod(int(common.argmin()), n))
        pairs.append((int(name[a]), int(name[b])))
        center = (centers[a] * weights[a] + centers[b] * weights[b]) / (weights[a] + weights[b])
        radii[a] = max(np.linalg.norm(center - centers[i]) + radii[i] for i in (a, b))
        centers[a], weights[a], name[a] = center, weights[a] + weights[b], made
        common[b] = common[:, b] = np.inf
        gone = np.isinf(common[a])
        common[a] = np.where(gone, np.inf, np.sqrt(((centers - center) ** 2).sum(1)) + radii + radii[a])
        common[:, a] = common[a]
        common[a, a] = np.inf
    return pairs


def _runs(points: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum, center and radius of runs of points."""
    total = np.add.reduceat(points, starts)
    center = total / counts[:, None]
    away = ((points - np.repeat(center, counts, 0)) ** 2).sum(1)
    return total, center, np.sqrt(np.maximum.reduceat(away, starts))


def plant(points: np.ndarray) -> Forest:
    """The trees over ``points`` (parts, n, width), integers; n is at least 1."""
    parts, n, width = points.shape
    flat = points.reshape(-1, width)
    order = np.arange(parts * n)
    # Two levels of anchors: of each part, and of each anchor.
    owner = _anchors(flat.astype(float), np.arange(0, parts * n, n), np.full(parts, n))
    label = np.repeat(np.arange(parts), n) * n + owner
    order = np.argsort(label, kind="stable")
    label = label[order]
    starts = np.flatnonzero(np.diff(label, prepend=-1))
    counts = np.diff(starts, append=len(label))
    sub = _anchors(flat[order].astype(float), starts, counts)
    label = label * n + sub
    again = np.argsort(label, kind="stable")
    order, label = order[again], label[again]
    _, center, radius = _runs(flat[order], starts, counts)

    # Order each part's anchors as the leaves of its merges.
    ranks, merges = np.empty(len(starts), np.int64), []
    of_part = starts // n
    for part in range(parts):
        own = np.flatnonzero(of_part == part)
        pairs = _merged(center[own], counts[own], radius[own])
        leaves = [[i] for i in range(len(own))]
        for a, b in pairs:
            leaves.append(leaves[a] + leaves[b])
        ranks[own[leaves[-1]]] = own[0] + np.arange(len(own))
        merges.append((own[0], len(own), pairs, leaves))
    by_rank = np.argsort(ranks)
    pieces = [np.arange(starts[i], starts[i] + counts[i]) for i in by_rank]
    again = np.concatenate(pieces)
    order, label = order[again], label[again]
    counts = counts[by_rank]
    starts = np.cumsum(counts) - counts

    # Nodes as (part, low, high), children listed; roots first.
    nodes: list[tuple[int, int, int]] = [(p, p * n, p * n + n) for p in range(parts)]
    first, last = [0] * parts, [0] * parts
    lowest = np.flatnonzero(np.diff(label, prepend=-1))
    ends = np.append(lowest[1:], len(label))
    for part, (base, k, pairs, leaves) in enumerate(merges):
        # Nodes still to get their children: (place, ball); balls below k are anchors.
        open_balls = [(part, 2 * k - 2)]
        while open_balls:
            place, ball = open_balls.pop()
            first[place] = len(nodes)
            if ball >= k:
                for child in pairs[ball - k]:
                    held = ranks[base + np.array(leaves[child])]
                    low, high = int(starts[held.min()]), int(starts[held.max()] + counts[held.max()])
                    open_balls.append((len(nodes), child))
                    nodes.append((part, low, high))
                    first.append(0)
                    last.append(0)
            else:
                low, high = np.searchsorted(lowest, nodes[place][1:])
                if high - low > 1:
                    for i in range(low, high):
                        nodes.append((part, int(lowest[i]), int(ends[i])))
                        first.append(0)
                        last.append(0)
            last[place] = len(nodes)
    part, low, high = np.array(nodes).T
    held = flat[order]
    sums = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(held, 0, dtype=np.int64)])
    total = sums[high] - sums[low]
    center = total / (high - low)[:, None]
    size = high - low
    rows = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
    away = ((held[rows] - np.repeat(center, size, 0)) ** 2).sum(1)
    radius = np.sqrt(np.maximum.reduceat(away, np.cumsum(size) - size))
    return Forest(order.reshape(parts, n) % n, part, low, high, np.array(first), np.array(last), radius, total)


def _ranges(lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    sizes = highs - lows
    return np.repeat(lows - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def assign(forest: Forest, points: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Who owns what: owned nodes and their entries, and single points (places in the order of
    all parts), their entries and the points themselves. ``codebooks``: (parts, entries, width)."""
    parts, n, width = points.shape
    entries = codebooks.shape[1]
    nodes, may = np.arange(parts), np.ones((parts, entries), bool)
    owned, owners, open_leaves, open_may = [], [], [], []
    while len(nodes):
        center = forest.total[nodes] / (forest.high - forest.low)[nodes][:, None]
        d = np.sqrt(((center[:, None] - codebooks[forest.part[nodes]]) ** 2).sum(2))
        d[~may] = np.inf
        reach = (d.min(1) + 2 * forest.radius[nodes])[:, None]
        may = d <= reach + 1e-9 * (reach + 1)  # rounding may keep an entry too many, never lose one
        single = may.sum(1) == 1
        owned.append(nodes[single])
        owners.append(may[single].argmax(1))
        is_leaf = forest.first[nodes] == forest.last[nodes]
        open_leaves.append(nodes[~single & is_leaf])
        open_may.append(may[~single & is_leaf])
        more = ~single & ~is_leaf
        below = forest.last[nodes[more]] - forest.first[nodes[more]]
        may = np.repeat(may[more], below, 0)
        nodes = _ranges(forest.first[nodes[more]], forest.last[nodes[more]])
    leaves, may = np.concatenate(open_leaves), np.concatenate(open_may)
    listed = may.sum(1)
    by_list = np.argsort(listed, kind="stable")
    leaves, may, listed = leaves[by_list], may[by_list], listed[by_list]
    places, chosen, held = [], [], []
    cost = np.cumsum(listed * (forest.high - forest.low)[leaves])
    for block in np.split(np.arange(len(leaves)), np.flatnonzero(np.diff(cost // PAIRS)) + 1):
        if len(block):
            own, low, high = leaves[block], forest.low[leaves[block]], forest.high[leaves[block]]
            lists = np.argsort(~may[block], axis=1, kind="stable")[:, : listed[block[-1]]]
            place, leaf = _ranges(low, high), np.repeat(np.arange(len(own)), high - low)
            part = forest.part[own][leaf]
            point = points[part, forest.order.reshape(-1)[place]]
            d = ((point[:, None] - codebooks[part[:, None], lists[leaf]]) ** 2).sum(2)
            d[np.arange(lists.shape[1]) >= listed[block][leaf][:, None]] = _FAR
            places.append(place)
            chosen.append(lists[leaf, d.argmin(1)])  # lists ascend: ties go to the lower entry
            held.append(point)
    if not places:
        places, chosen, held = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty((0, width), np.int64)]
    return np.concatenate(owned), np.concatenate(owners), np.concatenate(places), np.concatenate(chosen), np.concatenate(held)


def _integers(vectors: pa.Array, width: int) -> np.ndarray:
    values = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False).astype(float)).reshape(-1, width)
    if np.abs(values).max(initial=0) > np.sqrt(2**60 / width):
        raise ValueError("components too large: squared distances must fit into 64 bits")
    return values.astype(np.int64)


def _plant_chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(keys, labels, points and the forest's arrays) of each chunk."""
    for batch in batches:
        for low in range(0, batch.num_rows, CHUNK):
            some = batch.slice(low, CHUNK)
            points = _integers(some.column(2), width)
            n = len(points)
            forest = plant(_by_part(points))
            lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), some.column(i)) for i in range(2)]
            blobs = [pa.array([b], pa.binary()) for b in (points.astype("<i4" if np.abs(points).max() < 2**31 else "<i8").tobytes(), *forest.packed())]
            yield pa.RecordBatch.from_arrays([*lists, *blobs], names=["keys", "labels", *BLOBS])


BLOBS = ("points", "node_order", "part", "low", "high", "first", "last", "radius", "total")


def _by_part(points: np.ndarray) -> np.ndarray:
    return points.reshape(len(points), PARTS, points.shape[1] // PARTS).transpose(1, 0, 2)


def _chunks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray, Forest]]:
    for row in range(batch.num_rows):
        blobs = [batch.column(i)[row].as_buffer() for i in range(2, 2 + len(BLOBS))]
        keys, labels = (batch.column(i)[row].values for i in range(2))
        kind = "<i4" if blobs[0].size == 4 * width * len(keys) else "<i8"
        points = np.frombuffer(blobs[0], kind).reshape(-1, width).astype(np.int64)
        yield keys, labels, points, Forest.unpacked(blobs[1:], PARTS)


def _sums(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(part, entry, at, total, n): one row for each component of each entry that has points."""
    parts, entries, width = codebooks.shape
    totals, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
    for batch in batches:
        for _, _, points, forest in _chunks(batch, parts * width):
            owned, owner, place, entry, point = assign(forest, _by_part(points), codebooks)
            np.add.at(totals, (forest.part[owned], owner), forest.total[owned])
            np.add.at(counts, (forest.part[owned], owner), (forest.high - forest.low)[owned])
            np.add.at(totals, (place // len(points), entry), point)
            np.add.at(counts, (place // len(points), entry), 1)
    part, entry = np.nonzero(counts)
    at = np.tile(np.arange(width), len(part))
    part, entry = np.repeat(part, width), np.repeat(entry, width)
    columns = [part, entry, at, totals[part, entry, at], counts[part, entry]]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "at", "total", "n"])


def _codes(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts, _, width = codebooks.shape
    for batch in batches:
        for keys, labels, points, forest in _chunks(batch, parts * width):
            n, own = len(points), _by_part(points)
            owned, owner, place, entry, _ = assign(forest, own, codebooks)
            ordered = np.empty(parts * n, np.int64)
            ordered[_ranges(forest.low[owned], forest.high[owned])] = np.repeat(owner, (forest.high - forest.low)[owned])
            ordered[place] = entry
            code = np.empty((parts, n), np.int64)
            np.put_along_axis(code, forest.order.astype(np.int64), ordered.reshape(parts, n), 1)
            error = ((own - codebooks[np.arange(parts)[:, None], code]) ** 2).sum((0, 2))
            text = [bytes(row).hex() for row in code.T.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([keys, labels, pa.array(text, pa.string()), pa.array(error, pa.int64())], names=["key", "label", "code", "error"])


@dataclass
class Codes:
    """``rows``: (key, label, code, error), a written table; ``codebooks``: (parts, entries,
    width of a part), the final entries."""

    rows: DataFrame
    codebooks: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.reshape(-1).tolist())).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, every component finite, and to be cut into PARTS."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & (F.size(vector) % PARTS == 0) & finite, F.lit(False))


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> Codes:
    """The codes of all vectors, and the codebooks.

    A codebook begins as the parts of the ENTRIES vectors with the smallest keys, null keys
    last, ties by the components; with fewer vectors it has fewer entries. Left out are
    vectors that are null, empty, hold a null or a component that is not finite, cannot be
    cut into PARTS, or are not as long as the one with the smallest key. Null labels and
    repeated rows pass as they are; an empty table gives no rows and empty codebooks.
    Components whose squared distances would not fit into 64 bits raise. Other columns do
    not pass. Broadcast are the codebooks, whose size does not depend on the table; each
    round sends PARTS x ENTRIES sums from a task.
    """
    own = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    own = own.filter(usable(F.col("vector")))
    first = own.select("key", "vector").orderBy(F.col("key").asc_nulls_last(), "vector").limit(1).collect()
    width = len(first[0]["vector"]) if first else PARTS
    own = own.filter(F.size("vector") == width)
    smallest = own.select("key", "vector").orderBy(F.col("key").asc_nulls_last(), "vector").limit(ENTRIES).collect()
    start = _integers(pa.array([r["vector"] for r in smallest], pa.list_(pa.float64())), width)
    codebooks = _by_part(start).copy()

    kinds = {f.name: f.dataType for f in own.schema}
    schema = T.StructType().add("keys", T.ArrayType(kinds["key"])).add("labels", T.ArrayType(kinds["label"]))
    for name in BLOBS:
        schema = schema.add(name, "binary")
    chunks = written(own.mapInArrow(lambda batches: tidily(_plant_chunks(batches, width)), schema), "trees")
    for _ in range(ROUNDS if smallest else 0):
        known = codebooks
        sums = chunks.mapInArrow(lambda batches: tidily(_sums(batches, known)), "part long, entry long, at long, total long, n long")  # noqa: B023
        new = codebooks.copy()
        for r in sums.groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            new[r["part"], r["entry"], r["at"]] = r["total"] // r["n"]
        codebooks = new
    out = T.StructType().add("key", kinds["key"]).add("label", kinds["label"]).add("code", "string").add("error", "long")
    rows = chunks.mapInArrow(lambda batches: tidily(_codes(batches, codebooks)), out)
    return Codes(written(rows, "codes").withColumnsRenamed({"key": key, "label": label}), codebooks)


def with_label_error(codes: Codes, label: str = "label") -> DataFrame:
    """The rows with ``label_error``, the errors summed over equal labels, null ones together."""
    sums = codes.rows.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"))
    return codes.rows.join(sums, F.col(label).eqNullSafe(F.col("_label"))).drop("_label")
