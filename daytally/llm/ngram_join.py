"""Sets of word n-grams, joined by exact Jaccard similarity, as components.

Only the rarest members of a set are indexed, enough that two similar sets share one
(prefix filter). Frequent members come last in the order, so long lists are rare; the
order alone rests on their counts, never the result. Sets that are equal are one set, and a
pair is compared only if the indexed members it shares leave enough.

Relations between sets spare the rest. First each set is compared with the candidate it
shares most with; what is linked then has its answer, its component, from there, and only
what still is in different components is compared. Sets of a long list are kept as their
differences from one set, the pivot: what two of them share follows from the differences,
for whole blocks at once, and blocks whose sizes cannot fit or that are in one component
are skipped unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import gathered, maybe_in, small_batches, tidily
from daytally.llm.components import components
from daytally.llm.words import distinct_sorted, hashed_words, mix, shingles

#: Counts kept for the order of members: the largest ones, 4 MB.
COUNTS = 1 << 18
#: How much further than its index a set is looked at for that, as frequent members make
#: room for those behind them.
LOOK_AHEAD = 1.5
#: Index lists up to this length give all their pairs at once.
SHORT_LIST = 16
#: Lists of members counted this often are split.
SPLIT_AT = 1 << 15
ROWS = 1 << 17


@dataclass(frozen=True)
class Similarity:
    """At least ``percent`` of the union shared; ``words`` to a shingle."""

    words: int = 4
    percent: int = 85

    def least_shared(self, n):
        """Members that a set of ``n`` shares with any similar one, at least."""
        return -(-n * self.percent // 100)


def _sets(column: pa.Array, words: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    for first, _, hashes, bounds in hashed_words(column):
        yield first, distinct_sorted(*shingles(hashes, bounds, words))


def _leading(batches: Iterator[pa.RecordBatch], sim: Similarity) -> Iterator[pa.RecordBatch]:
    """The members that come first in each set by hash alone, and some more."""
    for batch in batches:
        for _, sets in _sets(batch.column(0), sim.words):
            some = [own[: ceil(LOOK_AHEAD * (len(own) - sim.least_shared(len(own)) + 1))] for own in sets]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(some).view(np.int64))], names=["member"])


def frequent(texts: DataFrame, sim: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Members that would have long lists, ascending by hash, and how many sets have them;
    the most frequent ones, as many as COUNTS. Only the order of members rests on it."""
    members = texts.mapInArrow(lambda batches: tidily(_leading(batches, sim)), "member long")
    counted = members.groupBy("member").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SHORT_LIST)
    with small_batches(texts.sparkSession):
        rows = counted.orderBy(F.desc("n"), "member").limit(COUNTS).toArrow()
    members = rows["member"].to_numpy().view(np.uint64)
    order = np.argsort(members)
    return members[order], rows["n"].to_numpy()[order]


def _count_of(members: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    if not len(known[0]) or not len(members):
        return np.zeros(len(members), np.int64)
    at = np.minimum(np.searchsorted(known[0], members), len(known[0]) - 1)
    return np.where(known[0][at] == members, known[1][at], 0)


def _signed(batches: Iterator[pa.RecordBatch], sim: Similarity, known: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Size, two hashes and the indexed members, rarest first, of each row's set."""
    a, b = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
    for batch in batches:
        for first, sets in _sets(batch.column(1), sim.words):
            members = np.concatenate(sets)
            counts = np.split(_count_of(members, known), np.cumsum([len(s) for s in sets])[:-1])
            out = {"n": [], "fa": [], "fb": [], "prefix": []}
            for own, count in zip(sets, counts):
                n = len(own)
                ordered = own[np.lexsort((own, count))] if count.any() else own
                out["n"].append(n)
                out["fa"].append(int(mix(own ^ a).sum().view(np.int64)) if n else 0)
                out["fb"].append(int(mix(own ^ b).sum().view(np.int64)) if n else 0)
                out["prefix"].append(ordered[: n - sim.least_shared(n) + 1 if n else 0].tobytes())
            columns = [pa.array(out["n"], pa.int32()), pa.array(out["fa"], pa.int64()), pa.array(out["fb"], pa.int64()), pa.array(out["prefix"], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), *columns], names=["id", *out])


def _posted(batches: Iterator[pa.RecordBatch], known: tuple[np.ndarray, np.ndarray], split_at: int) -> Iterator[pa.RecordBatch]:
    """A row for each indexed member: (member, part, id, n); part 0 is a whole list."""
    for batch in batches:
        for low in range(0, len(batch), 2048):
            some = batch.slice(low, 2048)
            lengths = np.array([len(x) // 8 for x in some.column(2).to_pylist()])
            if not lengths.sum():
                continue
            members = np.frombuffer(b"".join(some.column(2).to_pylist()), np.uint64)
            ids = np.repeat(some.column(0).to_numpy(), lengths)
            parts = (_count_of(members, known) // split_at).astype(np.uint64)
            part = np.where(parts > 0, 1 + mix(ids.view(np.uint64)) % np.maximum(parts, 1), 0).astype(np.int32)
            n = np.repeat(some.column(1).to_numpy(), lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array(members.view(np.int64)), pa.array(part), pa.array(ids), pa.array(n)], names=["member", "part", "id", "n"]
            )


PAIR, LONG, HEAD = 0, 1, 2
_FOUND = "kind int, member long, a long, b long, na int, nb int"


def _found(kind: int, member, a, b, na, nb) -> pa.RecordBatch:
    columns = [np.full(len(a), kind, np.int32), member, a, b, na.astype(np.int32), nb.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "member", "a", "b", "na", "nb"])


def _sizes_fit(na: np.ndarray, nb: np.ndarray, sim: Similarity) -> np.ndarray:
    return 100 * np.minimum(na, nb).astype(np.int64) >= sim.percent * np.maximum(na, nb).astype(np.int64)


def _lists(rows: list[np.ndarray], cut: tuple | None, sim: Similarity) -> Iterator[pa.RecordBatch]:
    """Candidates from whole lists; ``cut`` is a list of which a piece went before."""
    member, part, ids, n = rows
    first = np.concatenate([[True], (member[1:] != member[:-1]) | (part[1:] != part[:-1])])
    lengths = np.diff(np.append(np.flatnonzero(first), len(member)))
    size = np.repeat(lengths, lengths)
    is_long = (size > SHORT_LIST) | (part > 0)
    if cut is not None:
        is_long |= (member == cut[0]) & (part == cut[1])
    if is_long.any():
        m, i, k, start = member[is_long], ids[is_long], n[is_long], first[is_long]
        run = np.diff(np.append(np.flatnonzero(start), len(m)))
        head_id, head_n = np.repeat(i[start], run), np.repeat(k[start], run)
        yield _found(HEAD, m[start], i[start], i[start], k[start], k[start])
        yield _found(LONG, m, i, i, k, k)
        for a, na in ((head_id, head_n), (np.roll(i, 1), np.roll(k, 1))):
            use = ~start & (a != i) & _sizes_fit(na, k, sim)
            yield _found(PAIR, np.zeros(use.sum(), np.int64), a[use], i[use], na[use], k[use])
    few = ~is_long & (size > 1)
    owner, ids, n = np.cumsum(first)[few], ids[few], n[few]
    for lag in range(1, min(SHORT_LIST, len(ids))):
        use = (owner[lag:] == owner[:-lag]) & (ids[lag:] != ids[:-lag])
        if not use.any():
            break
        use &= _sizes_fit(n[lag:], n[:-lag], sim)
        yield _found(PAIR, np.zeros(use.sum(), np.int64), ids[:-lag][use], ids[lag:][use], n[:-lag][use], n[lag:][use])


def _walk(batches: Iterator[pa.RecordBatch], sim: Similarity) -> Iterator[pa.RecordBatch]:
    """Candidates from lists sorted by (member, part, id).

    A short list gives all its pairs of fitting sizes. A long one gives each row paired
    with the list's head and with the row before it, the rows themselves, for
    :func:`_rest`, and its head. One longer than ROWS goes in pieces, each like a list.
    """
    held: list[list[np.ndarray]] = []
    count, cut = 0, None
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        count += len(batch)
        if count < ROWS:
            continue
        rows = [np.concatenate(x) for x in zip(*held)]
        last = _start_of_last(rows)
        if last == 0:
            yield from _lists(rows, (rows[0][-1], rows[1][-1]), sim)
            cut, held, count = (rows[0][-1], rows[1][-1]), [], 0
        else:
            yield from _lists([c[:last] for c in rows], cut, sim)
            held, count = [[c[last:] for c in rows]], len(rows[0]) - last
    if count:
        yield from _lists([np.concatenate(x) for x in zip(*held)], cut, sim)


def _start_of_last(rows: list[np.ndarray]) -> int:
    other = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
    return int(other[-1]) + 1 if len(other) else 0


BLOCK = 512
BLOCK_BYTES = 1 << 20
PIVOT_TURNS = 3
#: Rows of one group that are sorted into blocks together.
PART = 1 << 12
_HEADER = [("group", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("one", pa.int64()), ("many", pa.bool_()), ("rows", pa.int32())]
_HEADER_TYPE = "group long, low int, high int, one long, many boolean, rows int"


def _blocks(batches: Iterator[pa.RecordBatch], payload: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows (group, part, n, id, component, ...) sorted by the first three, as blocks of up
    to BLOCK rows, and BLOCK_BYTES or one row, of one group and part: a header and the rows'
    columns as bytes."""
    schema = pa.schema([*_HEADER, *((name, pa.binary()) for name in payload)])
    for batch in batches:
        group, part, n, component = (batch.column(name).to_numpy() for name in ("group", "part", "n", "component"))
        new = np.flatnonzero((group[1:] != group[:-1]) | (part[1:] != part[:-1])) + 1
        held = np.zeros(len(batch), np.int64)
        for name in payload:
            if pa.types.is_binary(batch.schema.field(name).type):
                held += pc.binary_length(batch.column(name)).to_numpy()
        held = np.concatenate([[0], np.cumsum(held)])
        found = []
        for a, b in zip(np.append(0, new), np.append(new, len(batch))):
            high = a
            while high < b:
                low = high
                fits = int(np.searchsorted(held, held[low] + BLOCK_BYTES, "right")) - 1
                high = max(low + 1, min(b, low + BLOCK, fits))
                own = component[low:high]
                row = {"group": group[low], "low": n[low], "high": n[high - 1], "one": own[0], "many": bool((own != own[0]).any()), "rows": high - low}
                found.append(row | {name: _bytes_of(batch.column(name).slice(low, high - low)) for name in payload})
        if found:
            yield pa.RecordBatch.from_pylist(found, schema)


def _bytes_of(column: pa.Array) -> bytes:
    """Numbers as they are; of lists of bytes the lengths, then the bytes."""
    if pa.types.is_binary(column.type):
        values = column.to_pylist()
        return np.array([len(values), *map(len, values)], np.int64).tobytes() + b"".join(values)
    return column.to_numpy().tobytes()


def _lists_of(data: bytes, kind) -> list[np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    ends = np.cumsum(np.frombuffer(data, np.int64, n, 8)) + 8 * (n + 1)
    return [np.frombuffer(data[a:b], kind) for a, b in zip(np.append(8 * (n + 1), ends), ends)]


def _pairs_of_blocks(rows: DataFrame, payload: list[str], sim: Similarity) -> DataFrame:
    """The pairs of blocks of one group, with both payloads, whose sizes fit and that are
    not in one component. Groups are cut into parts, and pairs are dealt by block, so no
    task gets a group."""
    sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    part = F.pmod(F.xxhash64("id"), F.floor(F.col("size") / PART) + 1).cast("int")
    dealt = rows.join(sizes, "group").withColumn("part", part).select("group", "part", "n", "id", "component", *(c for c in payload if c not in ("n", "id", "component")))
    dealt = dealt.repartition("group", "part").sortWithinPartitions("group", "part", "n")
    kinds = _HEADER_TYPE + "".join(f", {name} binary" for name in payload)
    kept = dealt.mapInArrow(lambda batches: tidily(_blocks(batches, payload)), kinds)
    kept = gathered(kept.withColumn("block", F.monotonically_increasing_id()), "blocks")
    header = ["block", "low", "high", "one", "many"]
    x, y = (kept.select("group", *(F.col(c).alias(f"{side}_{c}") for c in header)) for side in "xy")
    sizes_fit = (F.col("x_high") * 100 >= F.col("y_low") * sim.percent) & (F.col("y_high") * 100 >= F.col("x_low") * sim.percent)
    unlike = F.col("x_many") | F.col("y_many") | (F.col("x_one") != F.col("y_one"))
    chosen = x.join(y, "group").filter((F.col("x_block") <= F.col("y_block")) & sizes_fit & unlike).select("x_block", "y_block")
    of = lambda side: kept.select(F.col("block").alias(f"{side}_block"), *(F.col(c).alias(f"{side}_{c}") for c in payload))
    return gathered(chosen, "block_pairs").join(of("x"), "x_block").join(of("y"), "y_block")


def _rest(batches: Iterator[pa.RecordBatch], sim: Similarity) -> Iterator[pa.RecordBatch]:
    """From pairs of blocks of a list: the pairs of rows in different components and with
    different pivots whose sizes fit."""
    kinds = {"id": np.int64, "component": np.int64, "n": np.int32, "pivot": np.int64}
    for batch in batches:
        for row in batch.to_pylist():
            x, y = ({c: np.frombuffer(row[f"{side}_{c}"], k) for c, k in kinds.items()} for side in "xy")
            apart = (x["component"][:, None] != y["component"]) & (x["pivot"][:, None] != y["pivot"])
            i, j = np.nonzero(apart & _sizes_fit(x["n"][:, None], y["n"][None, :], sim))
            turned = x["id"][i] > y["id"][j]
            sides = [np.where(turned, y[c][j], x[c][i]) for c in ("id", "n")], [np.where(turned, x[c][i], y[c][j]) for c in ("id", "n")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (sides[0][0], sides[1][0], sides[0][1], sides[1][1])], names=["a", "b", "na", "nb"])


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set by what it lacks of its pivot's (places) and has beyond it (members)."""
    for batch in batches:
        lacks, beyond, sizes = [], [], []
        for own, base in zip(batch.column(4), batch.column(5)):
            own, base = own.values.to_numpy(), base.values.to_numpy()
            lacks.append(np.flatnonzero(~np.isin(base, own, assume_unique=True)).astype(np.int32).tobytes())
            beyond.append(own[~np.isin(own, base, assume_unique=True)].tobytes())
            sizes.append(len(base))
        columns = [pa.array(sizes, pa.int32()), pa.array(lacks, pa.binary()), pa.array(beyond, pa.binary())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], *columns], names=["group", "id", "n", "component", "base", "lacks", "beyond"])


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many values each of ``x`` shares with each of ``y``: products of 0-1 matrices,
    over the values that occur on both sides."""
    out = np.zeros((len(x), len(y)), np.float32)
    known = np.intersect1d(np.unique(np.concatenate(x)), np.unique(np.concatenate(y)), assume_unique=True)
    width = 4096
    sides = []
    for side in (x, y):
        values = np.concatenate(side)
        owner = np.repeat(np.arange(len(side)), [len(v) for v in side])
        at = np.minimum(np.searchsorted(known, values), max(0, len(known) - 1))
        use = known[at] == values if len(known) else np.zeros(len(values), bool)
        sides.append((owner[use], at[use]))
    for low in range(0, len(known), width):
        tiles = []
        for (owner, at), side in zip(sides, (x, y)):
            tile = np.zeros((len(side), min(width, len(known) - low)), np.float32)
            own = (at >= low) & (at < low + width)
            tile[owner[own], at[own] - low] = 1
            tiles.append(tile)
        out += tiles[0] @ tiles[1].T
    return out


def _linked(batches: Iterator[pa.RecordBatch], sim: Similarity) -> Iterator[pa.RecordBatch]:
    """From pairs of blocks of sets with one pivot: links enough to join the components that
    any similar pair joins. The shared members of a pair follow from the differences."""
    for batch in batches:
        for row in batch.to_pylist():
            x, y = (
                {c: np.frombuffer(row[f"{side}_{c}"], k) for c, k in {"id": np.int64, "component": np.int64, "n": np.int32, "base": np.int32}.items()}
                | {"lacks": _lists_of(row[f"{side}_lacks"], np.int32), "beyond": _lists_of(row[f"{side}_beyond"], np.int64)}
                for side in "xy"
            )
            lacks = [np.array([len(v) for v in side["lacks"]]) for side in (x, y)]
            shared = x["base"][:, None] - lacks[0][:, None] - lacks[1][None, :] + _common(x["lacks"], y["lacks"]) + _common(x["beyond"], y["beyond"])
            union = x["n"][:, None] + y["n"][None, :] - shared
            i, j = np.nonzero((100 * shared >= sim.percent * union) & (x["component"][:, None] != y["component"][None, :]))
            parent: dict[int, int] = {}

            def root(c: int) -> int:
                while c in parent:
                    c = parent[c]
                return c

            a, b = [], []
            for p, q in zip(i.tolist(), j.tolist()):
                one, other = root(int(x["component"][p])), root(int(y["component"][q]))
                if one != other:
                    parent[max(one, other)] = min(one, other)
                    a.append(int(x["id"][p]))
                    b.append(int(y["id"][q]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _set_rows(batches: Iterator[pa.RecordBatch], sim: Similarity) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, sets in _sets(batch.column(1), sim.words):
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            members = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), members], names=["id", "members"])


def _sets_of(ids: DataFrame, rows: DataFrame, sim: Similarity) -> DataFrame:
    """(id, members): the whole sets of the documents ``ids``, read anew."""
    ids = gathered(ids.distinct(), "ids")
    needed = maybe_in(rows, "id", ids, "id").join(ids, "id", "left_semi")
    return needed.mapInArrow(lambda batches: tidily(_set_rows(batches, sim)), "id long, members array<long>")


def _links(pairs: DataFrame, rows: DataFrame, sim: Similarity) -> DataFrame:
    """The (a, b) of ``pairs`` that are similar, by their whole sets."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("id")), rows, sim)
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("members").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("members").alias("y")), "b"
    )
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - shared
    return both.filter(100 * shared.cast("long") >= sim.percent * union.cast("long")).select("a", "b")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component by now."""
    of = lambda end: labels.select(F.col("node").alias(end), F.col("component").alias(f"component_{end}"))
    known = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return known.filter(F.coalesce("component_a", "a") != F.coalesce("component_b", "b")).select("a", "b")


def _beyond(pairs: DataFrame, c: Column, sim: Similarity) -> DataFrame:
    """The pairs that can be similar if they share ``c`` indexed members.

    All members of one's index at or before the other's last one are in both indexes, so
    besides these a pair shares no more than what one of the two has not indexed.
    """
    beyond = F.ceil(F.greatest("na", "nb") * sim.percent / 100) - 1
    need = F.ceil((F.col("na") + F.col("nb")) * sim.percent / (100 + sim.percent))
    return pairs.filter(c + beyond >= need)


def _plausible(pairs: DataFrame, long_rows: DataFrame, sim: Similarity) -> DataFrame:
    """Candidates that can be similar, by the members they share in short lists and the
    number of long lists that each is in."""
    in_long = gathered(long_rows.groupBy("a").agg(F.count(F.lit(1)).alias("h")), "long")
    of = lambda end: in_long.select(F.col("a").alias(end), F.col("h").alias(f"h{end}"))
    more = F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0)))
    known = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return _beyond(known, F.col("c") + more, sim).select("a", "b", "c")


def _most_common(rows: DataFrame, key: str, value: str) -> DataFrame:
    """The value that most rows of a key have; of several the smallest."""
    counted = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("c"))
    return counted.groupBy(key).agg(F.max_by(value, F.struct("c", -F.col(value))).alias(value))


def _pivots(in_lists: DataFrame, mixed: DataFrame) -> DataFrame:
    """(id, pivot): the pivot that most lists of a set have, where a list first has its
    first set and then what most of its sets have. Sets that share lists come to share it."""
    of_list = mixed.select("member", F.col("head").alias("pivot"))
    for turn in range(PIVOT_TURNS):
        of_set = gathered(_most_common(in_lists.select("member", "id").join(of_list, "member"), "id", "pivot"), "pivots")
        if turn < PIVOT_TURNS - 1:
            of_list = gathered(_most_common(in_lists.select("member", "id").join(of_set, "id"), "member", "pivot"), "pivots")
    return of_set


def join(
    docs: DataFrame, sim: Similarity = Similarity(), text: str = "text", key: str = "doc_id", split_at: int = SPLIT_AT
) -> DataFrame:
    """(key, n_shingles, component_id) for every row of ``docs``.

    ``component_id`` is the smallest key that links lead to, the row's own included. A
    null, empty or blank text has no shingles and no links. Rows with one key are one
    document where a link is concerned. A null key links nothing and has a null component
    unless its text equals another row's. Texts of any length count whole, and repeated rows
    and equal texts each have their row. An empty table gives an empty result; columns other
    than text and key do not pass.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    known = frequent(rows.select("text"), sim)
    signed = gathered(rows.mapInArrow(lambda batches: tidily(_signed(batches, sim, known)), "id long, n int, fa long, fb long, prefix binary"), "signed")
    same = ["n", "fa", "fb"]
    groups = gathered(signed.filter("n > 0").groupBy(*same).agg(F.min("id").alias("rep"), F.first("prefix").alias("prefix")), "sets")

    posted = groups.filter("rep IS NOT NULL").select("rep", "n", "prefix")
    posted = posted.mapInArrow(lambda batches: tidily(_posted(batches, known, split_at)), "member long, part int, id long, n int")
    lists = posted.repartition("member", "part").sortWithinPartitions("member", "part", "id")
    found = gathered(lists.mapInArrow(lambda batches: tidily(_walk(batches, sim)), _FOUND), "found")
    long_rows = found.filter(F.col("kind") == LONG)
    heads = found.filter(F.col("kind") == HEAD).select("member", F.col("a").alias("b"), F.col("na").alias("nb"))
    least = heads.groupBy("member").agg(F.min("b").alias("a"), F.min_by("nb", "b").alias("na"))
    between = heads.join(least, "member").filter("a < b").select("a", "b", "na", "nb")
    pairs = found.filter(F.col("kind") == PAIR).select("a", "b", "na", "nb").unionByName(between)
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    counted = gathered(counted, "counted")
    candidates = gathered(_plausible(counted, long_rows, sim), "candidates")

    best = gathered(candidates.groupBy("b").agg(F.max_by("a", F.struct("c", -F.col("a"))).alias("a")).select("a", "b"), "best")
    links = gathered(_links(best, rows, sim), "near")
    labels = gathered(components(links), "labels")

    in_lists = long_rows.select("member", F.col("a").alias("id"), F.col("na").alias("n"))
    in_lists = in_lists.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = in_lists.groupBy("member").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("id").alias("head"))
    mixed = gathered(mixed.filter("low < high").select("member", "head"), "mixed")
    in_lists = gathered(in_lists.join(mixed.select("member"), "member", "left_semi"), "in_lists")
    own = in_lists.groupBy("id").agg(F.first("n").alias("n"), F.first("component").alias("component"))
    pivots = gathered(own.join(_pivots(in_lists, mixed), "id"), "pivots")
    sets = _sets_of(pivots.select(F.explode(F.array("id", "pivot")).alias("id")), rows, sim)
    with_base = (
        pivots.join(sets, "id")
        .join(sets.select(F.col("id").alias("pivot"), F.col("members").alias("base")), "pivot")
        .select(F.col("pivot").alias("group"), "id", "n", "component", "members", "base")
    )
    apart = with_base.mapInArrow(lambda batches: tidily(_differences(batches)), "group long, id long, n int, component long, base int, lacks binary, beyond binary")
    same_pivot = _pairs_of_blocks(apart, ["id", "component", "n", "base", "lacks", "beyond"], sim)
    links = links.unionByName(gathered(same_pivot.mapInArrow(lambda batches: tidily(_linked(batches, sim)), "a long, b long"), "same_pivot"))

    several = pivots.select("id", "pivot").join(in_lists.select("member", "id", "n", "component"), "id")
    crossed = several.groupBy("member").agg(F.min("pivot").alias("low"), F.max("pivot").alias("high")).filter("low < high").select("member")
    several = several.join(crossed, "member", "left_semi").withColumnRenamed("member", "group")
    rest = _pairs_of_blocks(several, ["id", "component", "n", "pivot"], sim).mapInArrow(lambda batches: tidily(_rest(batches, sim)), "a long, b long, na int, nb int")
    rest = rest.groupBy("a", "b").agg(F.count(F.lit(1)).alias("in_long"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    rest = rest.join(counted.select("a", "b", "c"), ["a", "b"], "left")
    rest = _beyond(rest, F.col("in_long") + F.coalesce("c", F.lit(0)), sim).select("a", "b")
    left = _apart(candidates.select("a", "b").unionByName(rest).distinct(), gathered(components(links), "labels"))
    more = _links(gathered(left.join(best, ["a", "b"], "left_anti"), "left"), rows, sim)
    found_in = gathered(components(links.unionByName(more)), "components")

    member_of = signed.select("id", *same).join(groups.select(*same, "rep"), same, "left")
    labelled = member_of.join(found_in.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("component", "rep", "id").alias("component_id")
    return labelled.select(F.col("id").alias(key), F.col("n").cast("long").alias("n_shingles"), component)


def one_of_each(docs: DataFrame, sim: Similarity = Similarity(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose key is the smallest of their component, and those with a
    null key, with their own columns, whatever these are called.

    Rows without words are linked with nothing and stay; texts of any length count whole;
    repeated rows share a key and stay together; an empty table gives an empty result.
    """
    name = "dropped_key"
    while name in docs.columns:
        name += "_"
    dropped = join(docs, sim, text, key).filter(F.col(key) != F.col("component_id")).select(F.col(key).alias(name))
    return docs.join(gathered(dropped, "dropped"), F.col(f"`{key}`") == F.col(name), "left_anti")
