"""Packing of tokenised documents into sequences of several context sizes.

Documents are dealt into pools by hash, and each pool is packed by itself: full windows of
the longest size first; then what is left of each document goes to the tier of the smallest
context size that holds it. From the longest tier down, the longest piece opens a window of
the tier's size, and its gap is filled from the shorter tiers: by the longest whole piece
that fits, as often as one does, and at last by the beginning of a piece that is cut there.
So every window is full. The tail of a pool, less than one window, is cut into sequences of
powers of two. The windows of a size are dealt to step groups: equally many tokens in each,
and the cost of attention (squares of piece lengths) spread evenly.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm import bpe
from daytally.llm.common import text_or_empty, tidily
from daytally.llm.known import HashedIds
from daytally.llm.words import EXACT, segment_hashes, text_bytes

VOCABULARY = "byte_bpe_50k.json"
END_ID = 1
#: Context sizes, longest first, each half of the one before.
SIZES = (2048, 1024, 512, 256)
#: Documents of a pool, on average, and tokens after which a pool is packed and begun anew:
#: what bounds a task's memory.
POOL_DOCS = 4096
POOL_TOKENS = 1 << 22
#: Tokens of a step group, at most.
STEP_TOKENS = 16 * SIZES[0]
#: Tokens of a batch of packed pieces.
BATCH = 1 << 19
OUT = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset", "step")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


class PieceEncoder(bpe.Encoder):
    """The tokenizers library over plain texts, each distinct piece of text encoded once.

    No token goes over a single space or line end between two other characters, nor from an
    ASCII letter to a mark, so texts are cut there. New pieces that begin with such a gap
    go to the library in one chain, and are told apart by the lengths of the tokens' bytes.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self._pieces = HashedIds("<u4", bpe.KNOWN)
        self._bytes_in = np.zeros(max(self.bytes_of) + 1, np.int64)
        for token, data in self.bytes_of.items():
            self._bytes_in[token] = len(data)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: Iterable[str]) -> None:
        if len(self._words) > bpe.CACHED:
            self._words.clear()
        new = sorted({w for w in words if w not in self._words})
        for word, ids in zip(new, self._ids(new)):
            self._words[word] = np.array(ids, "<u4").tobytes()

    def _learn_pieces(self, hashes: np.ndarray, pieces: list[bytes], chained: np.ndarray) -> np.ndarray:
        """The places of new, distinct pieces, once they are known."""
        chain = [p for p, c in zip(pieces, chained) if c]
        ids = np.array(self._ids([b"".join(chain).decode()])[0], np.uint32)
        until = np.searchsorted(np.cumsum(self._bytes_in[ids]), np.cumsum([*map(len, chain)], dtype=np.int64)) + 1
        others = self._ids([p.decode() for p, c in zip(pieces, chained) if not c])
        lengths = np.zeros(len(pieces), np.int32)
        lengths[chained] = np.diff(until, prepend=0)
        lengths[~chained] = [*map(len, others)]
        found = np.empty(int(lengths.sum()), np.uint32)
        of_chain = np.repeat(chained, lengths)
        found[of_chain] = ids
        found[~of_chain] = [i for own in others for i in own]
        return self._pieces.learn(hashes, lengths, found)

    def encode_plain(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        data, at = text_bytes(texts)
        for first, last in bpe.groups(texts, bpe.PIECE):
            low = int(at[first])
            own, firsts = data[low : int(at[last])], at[first:last] - low
            solid, gap = own > 0x20, np.zeros(len(own), bool)
            gap[1:-1] = ((own == 0x20) | (own == 0x0A))[1:-1] & solid[:-2] & solid[2:]
            cut = gap.copy()
            cut[1:] |= _LETTER[own[:-1]] & _MARK[own[1:]]
            gap[firsts[firsts < len(own)]] = False
            cut[firsts[firsts < len(own)]] = True
            starts = np.flatnonzero(cut)
            ends = np.append(starts[1:], len(own))[: len(starts)]
            hashes = segment_hashes(own, starts, ends, EXACT)
            self._pieces.make_room()
            places = self._pieces.places(hashes)
            missing = np.flatnonzero(places < 0)
            if len(missing):
                distinct, sample, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
                new = missing[sample]
                pieces = [own[a:b].tobytes() for a, b in zip(starts[new].tolist(), ends[new].tolist())]
                places[missing] = self._learn_pieces(distinct, pieces, gap[starts[new]] & solid[ends[new] - 1])[which]
            ids, before = self._pieces.ids_of(places)
            yield first, ids, before[np.searchsorted(starts, np.append(firsts, len(own)))]


@cache
def encoder(path: str) -> PieceEncoder:
    """One for each Python worker, until it packs: what a task has learned the next ones know."""
    return PieceEncoder(path)


def _tokens(batches: Iterator[pa.RecordBatch], path: str, end_id: int, width: int) -> Iterator[pa.RecordBatch]:
    """(row, ids) with the end id, ``width`` bytes each."""
    for carried, ids, at in bpe._encode_batches(batches, encoder(path)):
        ended = np.insert(ids, at[1:], end_id).astype(f"<u{width}")
        at = at + np.arange(len(at))
        binary = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * width).astype(np.int32)), pa.py_buffer(ended)])
        yield pa.RecordBatch.from_arrays([carried, binary], names=["row", "ids"])


Piece = tuple[int, int, int]  # length, document, start


def pack_pool(lengths: list[int], sizes: tuple[int, ...] = SIZES) -> list[list[Piece]]:
    """Sequences that together hold each token of documents of ``lengths`` once; each is as
    long as one of ``sizes`` but the last ones, which are shorter powers of two."""
    out: list[list[Piece]] = []
    shelf: list[Piece] = []
    for doc, n in enumerate(lengths):
        whole = n - n % sizes[0]
        out += [[(sizes[0], doc, start)] for start in range(0, whole, sizes[0])]
        if n > whole:
            shelf.append((n - whole, doc, whole))
    shelf.sort()
    for size, shorter in zip(sizes, (*sizes[1:], 0)):
        while shelf and shelf[-1][0] > shorter:
            window = [shelf.pop()]
            gap = size - window[0][0]
            while gap and shelf:
                fits = bisect_right(shelf, gap, key=lambda piece: piece[0])
                length, doc, start = shelf.pop(max(fits - 1, 0))
                if length > gap:
                    insort(shelf, (length - gap, doc, start + gap))
                    length = gap
                window.append((length, doc, start))
                gap -= length
            out += _powers(window, size - gap) if gap else [window]
    return out


def _powers(window: list[Piece], n: int) -> list[list[Piece]]:
    """The window's ``n`` tokens as sequences of powers of two, longest first."""
    out, rest = [], window[::-1]
    while n:
        room = 1 << (n.bit_length() - 1)
        n -= room
        out.append([])
        while room:
            length, doc, start = rest.pop()
            if length > room:
                rest.append((length - room, doc, start + room))
                length = room
            out[-1].append((length, doc, start))
            room -= length
    return out


def steps(sequences: list[list[Piece]], sizes: tuple[int, ...] = SIZES, tokens: int = STEP_TOKENS) -> list[int]:
    """The step group of each sequence: of one size each, the tails in one of their own.

    A size's sequences go to as few groups as hold ``tokens`` each, in order of their cost,
    there and back over the groups.
    """
    group, used = [0] * len(sequences), 0
    lengths = [sum(p[0] for p in s) for s in sequences]
    for size in (*sizes, None):
        own = [i for i, n in enumerate(lengths) if (n == size if size else n not in sizes)]
        own.sort(key=lambda i: (-sum(p[0] ** 2 for p in sequences[i]), i))
        n = -(-len(own) * size // tokens) if size else min(len(own), 1)
        for turn, i in enumerate(own):
            place = turn % (2 * n)
            group[i] = used + min(place, 2 * n - 1 - place)
        used += n
    return group


@dataclass
class _Pool:
    """What is held of a pool, and how many sequences and steps it has had."""

    number: int | None
    n_sequences: int = 0
    n_steps: int = 0
    keys: list = field(default_factory=list)
    texts: list[np.ndarray] = field(default_factory=list)
    held: int = 0

    def pack(self, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """Pack what is held and let it go."""
        sequences = pack_pool([*map(len, self.texts)])
        groups = steps(sequences)
        rows, size = [], 0
        for pieces, group in zip(sequences, groups):
            at = 0
            for length, doc, start in pieces:
                own = self.texts[doc]
                ids = own[start : start + length].astype("<u4").tobytes()
                rows.append((self.keys[doc], start, length, ids, len(own), self.number << 32 | self.n_sequences, at, self.number << 32 | self.n_steps + group))
                at += length
            size += at
            self.n_sequences += 1
            if size > BATCH:
                yield _batch(rows, key_type)
                rows, size = [], 0
        if rows:
            yield _batch(rows, key_type)
        self.n_steps += max(groups, default=-1) + 1
        self.keys, self.texts, self.held = [], [], 0


def _batch(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    kinds = [key_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["key", *OUT])


def _packed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Rows of a pool follow one another; each pool, or part of it, is packed on its own."""
    encoder.cache_clear()  # its memory is for the pools now
    pool, key_type = _Pool(None), pa.null()
    for batch in batches:
        key_type = batch.schema.field(0).type
        for key, number, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if number != pool.number or pool.held > POOL_TOKENS:
                yield from pool.pack(key_type)
                if number != pool.number:
                    pool = _Pool(number)
            pool.keys.append(key)
            pool.texts.append(np.frombuffer(ids, f"<u{width}"))
            pool.held += len(pool.texts[-1])
    yield from pool.pack(key_type)


def pack(docs: DataFrame, path: str, end_id: int = END_ID, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, start, length, ids, doc_tokens, sequence_id, offset, step): a row for each piece
    of a document in a sequence. ``ids`` are 4 bytes each, little endian; ``start`` counts
    from the document's first id, ``offset`` from the sequence's; ``doc_tokens`` counts all
    ids of the document, its end id included.

    Sequences are full: as long as a context size, but for at most one of each shorter power
    of two in a pool. The same rows give the same result whatever the partitions. A null
    text is empty and has its end id alone; a text of any length is cut whole; repeated rows,
    ties and null keys are documents of their own; an empty table gives an empty result.
    Other columns do not pass. Only token ids are shuffled, once, by pool. Rows with equal
    key and text share a pool, which is packed in parts of bounded size.
    """
    known = bpe.encoder(path)
    width = 2 if max(*known.bytes_of, *known.special.values(), end_id) < 1 << 16 else 4
    pools = max(1, -(-docs.count() // POOL_DOCS))
    place = F.xxhash64(F.col(f"`{key}`"), text_or_empty(text))
    rows = docs.select(F.struct(F.col(f"`{key}`").alias("key"), place.alias("place")).alias("row"), text_or_empty(text).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType())])
    encoded = rows.mapInArrow(lambda batches: tidily(_tokens(batches, path, end_id, width)), schema)
    pool = F.pmod("row.place", F.lit(pools))
    dealt = encoded.select(F.col("row.key").alias("key"), pool.alias("pool"), "ids", F.col("row.place").alias("place"))
    pooled = dealt.repartition("pool").sortWithinPartitions("pool", "place", "key").drop("place")
    out = T.StructType().add("key", docs.schema[key].dataType)
    for name in OUT:
        out = out.add(name, "binary" if name == "ids" else "long")
    return pooled.mapInArrow(lambda batches: tidily(_packed(batches, width)), out).withColumnRenamed("key", key)


def vocabulary(name: str = VOCABULARY) -> str:
    return bpe.vocabulary(name)
