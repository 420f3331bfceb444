"""Byte-pair encoding by a walk over a trie of distinct words, and decoding.

For each prefix of a word only the last token of its encoding matters: the token ``t``
that ends at a position is the one suffix in the vocabulary that stands next to the last
token of the prefix before it, where two tokens may stand together if encoding their joint
bytes gives these two back. Walking all distinct words in the order of a trie, depth
first, a prefix that many words share is computed once.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterable, Iterator
from functools import cache, cached_property
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from daytally.llm.common import keep_batches_small, tidily, tokenizer
from daytally.llm.known import KnownIds
from daytally.llm.words import EXACT, segment_hashes, text_bytes

VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: how the byte-level vocabulary cuts a text into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Below this character the pattern above agrees with any version of Unicode.
SETTLED = "Ͱ"
#: First bytes of the UTF-8 forms of white space beyond ASCII.
OTHER_SPACE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
#: Pieces of text whose ids a Python worker knows before it starts anew: about 40 MB.
KNOWN = 1 << 20
#: Encoded words held by a Python worker before it starts anew; memory only.
CACHED = 300_000
#: Pairs of tokens of which a worker remembers whether they may stand together; likewise.
PAIRS = 500_000
#: Stands for the beginning of a word.
START = (1 << 24) - 1
#: Lengths of the tokens that may end where no longer one does.
SHORT = (2, 1)
#: Bytes of text whose words are held at a time.
GROUP = 1 << 18
PIECE = 1 << 18
SLICE = 1 << 20
BLOCK = 1 << 16


def _alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _lengths_by_end(tokens: Iterable[bytes]) -> dict[bytes, tuple[int, ...]]:
    """How long the tokens are that end with the same three bytes, longest first; two and one
    last, as shorter tokens are not told by their ends."""
    found: dict[bytes, set[int]] = {}
    for token in tokens:
        if len(token) > 2:
            found.setdefault(token[-3:], {2, 1}).add(len(token))
    return {end: tuple(sorted(lengths, reverse=True)) for end, lengths in found.items()}


def _vocabulary(path: str) -> tuple[dict[bytes, int], dict[int, bytes], dict[str, int], list[tuple[bytes, bytes]]]:
    """Of a vocabulary file: ids by bytes, bytes by id, special tokens, and the merges."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    of = _alphabet()
    raw = lambda shown: bytes(of[c] for c in shown)
    ids = {raw(token): i for token, i in spec["model"]["vocab"].items()}
    own = {token: token for token in ids}  # the merges share their tokens' bytes
    merges = [(own[raw(a)], own[raw(b)]) for a, b in spec["model"]["merges"]]
    return ids, {i: token for token, i in ids.items()}, {t["content"]: t["id"] for t in spec["added_tokens"]}, merges


class Encoder:
    """One vocabulary file: words to ids, ids to bytes."""

    def __init__(self, path: str):
        self.ids, self.bytes_of, self.special, merges = _vocabulary(path)
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self._lengths = _lengths_by_end(self.ids)
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._path = path
        self._made = {a + b: (rank, a, b) for (a, b), rank in self.ranks.items()}
        self._length = {i: len(token) for token, i in self.ids.items()}
        self._together: dict[int, bool] = {}
        self._edges: dict[tuple[bytes, int], list[tuple[bytes, int, int]]] = {}
        self._words: dict[str, bytes] = {}
        self._pieces = KnownIds("<u4", KNOWN)

    def merged(self, data: bytes) -> list[bytes]:
        """The merges, lowest rank first, as the vocabulary defines them; for short bytes."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.ranks.get(pair, len(self.ranks)) for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == len(self.ranks):
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, key: int, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before``, or begin a word if that is START."""
        if len(self._together) > PAIRS:
            self._together.clear()
        own = self.bytes_of[token]
        known = self.merged(own) == [own] if before == START else self._stay(self.bytes_of[before], own)
        self._together[key] = known
        return known

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int, int]]:
        """What stands at the left (1) or right (2) edge of a token while its bytes merge:
        each piece with the ranks of the merge that made it and of the one that took it."""
        known = self._edges.get((token, side))
        if known is None:
            known, taken = [], len(self.ranks)
            piece = token
            while True:
                rank, *parts = self._made.get(piece, (-1,))
                known.append((piece, rank, taken))
                if not parts:
                    break
                piece, taken = parts[side - 1], rank
            self._edges[token, side] = known
        return known

    def _stay(self, before: bytes, token: bytes) -> bool:
        """Whether two tokens side by side stay apart: no merge over their border comes
        while both its pieces stand there. Of equal merges the left one goes first."""
        for a, a_made, a_taken in self._edge(before, 2):
            for b, b_made, b_taken in self._edge(token, 1):
                rank = self.ranks.get((a, b))
                if rank is not None and a_made < rank > b_made and rank < a_taken and rank <= b_taken:
                    return False
        return True

    def walk(self, words: Iterable[bytes]) -> Iterator[list[int]]:
        """The ids of each of ``words``, which come in ascending order: from one word to the
        next only the states below their common prefix are dropped."""
        last = [START]
        previous = b""
        find, lengths, together, length = self.ids.get, self._lengths.get, self._together, self._length
        for word in words:
            shared, most = 0, min(len(word), len(previous))
            while shared < most and word[shared] == previous[shared]:
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for size in lengths(word[end - 3 : end], SHORT) if end > 2 else SHORT:
                    start = end - size
                    if start < 0:
                        continue
                    token = find(word[start:end])
                    if token is not None:
                        key = last[start] << 24 | token
                        fits = together.get(key)
                        if fits or fits is None and self._fits(key, last[start], token):
                            last.append(token)
                            break
                else:
                    raise ValueError("the vocabulary lacks a byte")
            previous = word
            tokens, end = [], len(word)
            while end:
                tokens.append(last[end])
                end -= length[last[end]]
            yield tokens[::-1]

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words that are not known yet."""
        if len(self._words) > CACHED:
            self._words.clear()
        new = {w.encode(): w for w in words if w not in self._words}
        ordered = sorted(new)
        for word, tokens in zip(ordered, self.walk(ordered)):
            self._words[new[word]] = array("I", tokens).tobytes()

    def is_plain(self, texts: pa.Array) -> np.ndarray:
        """Which texts :meth:`encode_plain` takes: not too long, without special tokens or
        first bytes that a white space beyond ASCII may have."""
        data, at = text_bytes(texts)
        odd = np.flatnonzero(OTHER_SPACE[data[at[0] : at[-1]]]) + at[0]
        plain = (np.searchsorted(odd, at[1:]) == np.searchsorted(odd, at[:-1])) & (np.diff(at) <= PIECE)
        for special in self.special:
            found = pc.match_substring(pc.fill_null(texts, ""), special)
            plain &= ~found.to_numpy(zero_copy_only=False)
        return plain

    def encode_plain(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Like ``encode`` for texts without special tokens and whose white space is ASCII:
        of runs of texts the first one's number, all ids, and where each text's begin.

        No word goes over a space or line end between two other characters, so texts fall
        into pieces there, and each distinct piece is cut and encoded once.
        """
        data, at = text_bytes(texts)
        for first, last in groups(texts, PIECE):
            low = int(at[first])
            own = data[low : int(at[last])]
            firsts = at[first:last] - low
            gap = (own == 0x20) | (own == 0x0A)
            solid = own > 0x20
            starts = np.zeros(len(own) + 1, bool)
            starts[1 : len(own) - 1] = gap[1:-1] & solid[:-2] & solid[2:] if len(own) > 2 else False
            starts[firsts] = True
            starts = np.flatnonzero(starts[: len(own)])
            ends = np.append(starts[1:], len(own))[: len(starts)]
            hashes = segment_hashes(own, starts, ends, EXACT)
            self._pieces.make_room()
            distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
            new = sample[self._pieces.missing(distinct)]
            pieces = [own[a:b].tobytes().decode() for a, b in zip(starts[new], ends[new])]
            cut = [WORDS.findall(p) for p in pieces]
            self.learn(w for words in cut for w in words)
            found = [b"".join(map(self._words.__getitem__, words)) for words in cut]
            lengths = np.fromiter((len(f) // 4 for f in found), np.int32, len(found))
            self._pieces.learn(hashes[new], lengths, np.frombuffer(b"".join(found), "<u4"))
            ids, before = self._pieces.ids_of(distinct, which)
            yield first, ids, before[np.searchsorted(starts, np.append(firsts, len(own)))]

    @cached_property
    def _library(self) -> Tokenizer:
        return tokenizer(self._path)

    def _cut(self, text: str) -> Iterator[str]:
        if text.isascii() or max(text) < SETTLED:
            return (m.group() for m in WORDS.finditer(text))
        return (text[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(text))

    def cut(self, text: str) -> Iterator[str | int]:
        """The words of a text in order; a special token in it comes as its id."""
        at = 0
        for found in self._special.finditer(text) if self._special else ():
            yield from self._cut(text[at : found.start()])
            yield self.special[found.group()]
            at = found.end()
        yield from self._cut(text[at:])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if sum(map(len, texts)) <= 2 * GROUP and not (self._special and any(self._special.search(t) for t in texts)):
            cut = [WORDS.findall(t) if t.isascii() or max(t) < SETTLED else [*self._cut(t)] for t in texts]
            self.learn(set().union(*cut))
            return [b"".join(map(self._words.__getitem__, words)) for words in cut]
        out = []
        for text in texts:
            whole, words = [], self.cut(text)
            while block := [*islice(words, BLOCK)]:
                self.learn({w for w in block if isinstance(w, str)})
                whole += [self._words[w] if isinstance(w, str) else w.to_bytes(4, "little") for w in block]
                whole = [b"".join(whole)]
            out.append(b"".join(whole))
        return out


class Decoder:
    """One vocabulary file: ids to text."""

    def __init__(self, path: str):
        _, bytes_of, special, _ = _vocabulary(path)
        bytes_of |= {i: s.encode() for s, i in special.items()}
        tokens = [bytes_of.get(i, b"") for i in range(max(bytes_of) + 1)]
        self._lengths = np.array([*map(len, tokens)], np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def texts(self, ids: np.ndarray, at: np.ndarray) -> pa.Array:
        """The texts of ``ids``, the i-th from ``at[i]`` to ``at[i + 1]``; special tokens are
        included, and bytes that are no UTF-8 are replaced."""
        lengths = self._lengths[ids]
        before = np.concatenate([[0], np.cumsum(lengths)])
        data = self._bytes[np.arange(before[-1]) + np.repeat(self._starts[ids] - before[:-1], lengths)]
        offsets = pa.py_buffer(before[at].astype(np.int32))
        found = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, offsets, pa.py_buffer(data)])
        try:
            return found.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in found.to_pylist()], pa.string())


@cache
def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)


@cache
def decoder(path: str) -> Decoder:
    return Decoder(path)


def groups(texts: pa.Array, size: int = GROUP) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > size:
            yield first, i
            first, held = i, 0
        held += int(n) + 1
    if first < len(lengths):
        yield first, len(lengths)


def _as_binary(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * 4).astype(np.int32)), pa.py_buffer(ids)])


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Keys, all ids and where each text's begin, for some rows at a time."""
    try:
        yield from _encode_batches(batches, encoder(path))
    finally:
        encoder.cache_clear()  # reading the vocabulary takes a fifth of a second


def _encode_batches(batches: Iterator[pa.RecordBatch], bpe: Encoder) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for batch in batches:
        for a, b in groups(batch.column(1), SLICE):
            some = batch.slice(a, b - a)
            plain = pa.array(bpe.is_plain(some.column(1)))
            easy, other = some.filter(plain), some.filter(pc.invert(plain))
            for first, ids, at in bpe.encode_plain(easy.column(1)):
                yield easy.column(0).slice(first, len(at) - 1), ids, at
            for first, last in groups(other.column(1)):
                texts = [t or "" for t in other.column(1).slice(first, last - first).to_pylist()]
                found = bpe.encode(texts)
                at = np.cumsum([0, *(len(f) // 4 for f in found)])
                yield other.column(0).slice(first, last - first), np.frombuffer(b"".join(found), "<u4"), at


def _keyed(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows, rows.schema["key"].dataType.simpleString()


def _rows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for keys, ids, at in _encoded(batches, path):
        yield pa.RecordBatch.from_arrays([keys, _as_binary(ids, at)], names=["key", "ids"])


def _both_ways(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for keys, ids, at in _encoded(batches, path):
        yield pa.RecordBatch.from_arrays([keys, _as_binary(ids, at), decoder(path).texts(ids, at)], names=["key", "ids", "decoded"])


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids) for every row: ``ids`` of the whole text, 4 bytes each, little endian.

    Ids equal those of the tokenizers library for the same file without added tokens. A
    null text is empty and has no ids; a text of any length is encoded whole, block by block;
    null keys pass; an empty table gives an empty result; equal rows give equal rows and rows
    with one key stay apart. Other columns do not pass.
    """
    rows, kind = _keyed(docs, text, key)
    return rows.mapInArrow(lambda batches: tidily(_rows(batches, path)), f"key {kind}, ids binary").withColumnRenamed("key", key)


def there_and_back(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded) for every row: as :func:`encode`, and the text that the ids decode
    to, in one pass. Nulls, empty and very long texts, ties, repeated rows and empty tables
    are taken as there; a null text decodes to the empty one."""
    keep_batches_small(docs.sparkSession)
    rows, kind = _keyed(docs, text, key)
    found = rows.mapInArrow(lambda batches: tidily(_both_ways(batches, path)), f"key {kind}, ids binary, decoded string")
    return found.withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids as column ``name``, which replaces one of that
    name. Special tokens are included, bytes that are no UTF-8 replaced; null ids give null."""
    if name in encoded.columns:
        encoded = encoded.drop(name)
    schema = T.StructType([*encoded.schema, T.StructField(name, T.StringType())])
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in groups(batch.column(names.index(ids))):
                own = batch.slice(a, b - a)
                column = own.column(names.index(ids))
                data, at = text_bytes(column)
                texts = decoder(path).texts(data[at[0] : at[-1]].view("<u4") if at[-1] > at[0] else np.empty(0, "<u4"), (at - at[0]) // 4)
                texts = pc.if_else(column.is_null(), pa.scalar(None, pa.string()), texts)
                yield pa.RecordBatch.from_arrays([*own.columns, texts], names=[*names, name])

    return encoded.mapInArrow(run, schema)


def vocabulary(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)
