"""Token ids as files of length-delimited records, with an index for shuffled reads.

Record file: for each document its length (8 bytes), the masked checksum of these
8 bytes (4), the payload, and the payload's masked checksum (4). Payload: a byte that
is 1 if there is a document id, the id (8 bytes), and the token ids of 2 or 4 bytes each.
Index file, in the same order: id (8 bytes), offset (8) and payload length (8) of each
record. Every number is little endian; checksums are CRC-32, rotated and shifted, so
that a checksum stored inside a payload does not check itself.

Documents are in ascending order of id over all files. A file is named by the attempt
that wrote it, and only files in the manifest count, so a task that runs again, or twice,
does no harm.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daytally.llm.common import tidily, tokenizer, written
from daytally.llm.known import KnownIds
from daytally.llm.words import BY_SPACE, EXACT, located_words, text_bytes
from daytally.session import new_folder

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: Fixed value: added to a rotated checksum.
MASK = 0xA282EAD8
PIECE = 1 << 20
#: Words a Python worker knows before it starts anew: about 50 MB. Memory only.
KNOWN = 1 << 21
_HEAD = struct.Struct("<Q")
_CHECK = struct.Struct("<I")
_KEY = struct.Struct("<Bq")
_INDEX = struct.Struct("<qQQ")
_MANIFEST = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_records", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32())])
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = _HEAD.pack(len(payload))
    return b"".join((head, _CHECK.pack(masked(head)), payload, _CHECK.pack(masked(payload))))


def unframed(file) -> Iterator[bytes]:
    """The payloads of an open record file; a broken record raises."""
    while head := file.read(_HEAD.size):
        payload = _payload(file, head)
        yield payload


def _payload(file, head: bytes) -> bytes:
    check = file.read(_CHECK.size)
    if len(head) < _HEAD.size or len(check) < _CHECK.size or _CHECK.unpack(check)[0] != masked(head):
        raise ValueError("broken record length")
    (length,) = _HEAD.unpack(head)
    payload, check = file.read(length), file.read(_CHECK.size)
    if len(payload) < length or len(check) < _CHECK.size or _CHECK.unpack(check)[0] != masked(payload):
        raise ValueError("broken record payload")
    return payload


class LibraryEncoder:
    """The tokenizers library over whole texts, each distinct word encoded once.

    Only for vocabularies that drop white space and whose rules see no further than a
    word: then a text's ids are those of its words, one after another.
    """

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self._known = KnownIds(f"<u{self.width}", KNOWN)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        found = []
        for low in range(0, len(words), 4096):
            some = [w.decode() for w in words[low : low + 4096]]
            found += [e.ids for e in self.library.encode_batch_fast(some, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int32, len(found))
        ids = np.fromiter((i for own in found for i in own), f"<u{self.width}", int(lengths.sum()))
        self._known.learn(hashes, lengths, ids)

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of runs of texts: the first text's number, all ids, and where each text's begin."""
        data, _ = text_bytes(texts)
        for first, _, hashes, bounds, starts, ends in located_words(texts, BY_SPACE, EXACT, PIECE):
            self._known.make_room()
            distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
            new = self._known.missing(distinct)
            self._learn(distinct[new], [data[a:b].tobytes() for a, b in zip(starts[sample[new]], ends[sample[new]])])
            ids, before = self._known.ids_of(distinct, which)
            yield first, ids, before[bounds]


@cache
def encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _write_part(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    bpe, part = encoder(path), TaskContext.get().partitionId()
    end = end_id.to_bytes(bpe.width, "little")
    files, top = open_folder(folder)
    name = f"part-{part:05d}-{uuid.uuid4().hex}"
    records = n_ids = at = 0
    out = index = None
    for batch in batches:
        keys = batch.column(0).to_pylist()
        for first, ids, bounds in bpe.encode(batch.column(1)):
            if out is None:
                files.create_dir(top, recursive=True)
                out, index = files.open_output_stream(f"{top}/{name}.rec"), files.open_output_stream(f"{top}/{name}.idx")
            for k, low, high in zip(keys[first:], bounds, bounds[1:]):
                payload = b"".join((_KEY.pack(k is not None, k or 0), ids[low:high].tobytes(), end))
                record = frame(payload)
                out.write(record)
                index.write(_INDEX.pack(k or 0, at, len(payload)))
                at += len(record)
                records += 1
                n_ids += (len(payload) - _KEY.size) // bpe.width
    if out is not None:
        out.close()
        index.close()
        yield pa.RecordBatch.from_pylist([{"part": part, "file": f"{folder}/{name}", "n_records": records, "n_ids": n_ids, "width": bpe.width}], _MANIFEST)


def write(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode every whole text and write it under ``folder``; returns the manifest:
    (part, file, n_records, n_ids, width), a row for each file, itself a written table.

    A null text is empty and has the end id alone; a text of any length is one record. Null
    ids come first; rows with one id are ordered by the hash of the text, and equal rows are
    records of their own. An empty table gives an empty manifest. Other columns do not pass.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("key", "tie").sortWithinPartitions("key", "tie")

    return written(ordered.drop("tie").mapInArrow(lambda batches: tidily(_write_part(batches, folder, path, end_id)), "part int, file string, n_records long, n_ids long, width int"), "manifest")


def _read_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            files, top = open_folder(f"{row['file']}.rec")
            start, held, size = row["before"], [], 0
            with files.open_input_stream(top, buffer_size=PIECE) as file:
                for payload in unframed(file):
                    known, key = _KEY.unpack_from(payload)
                    ids = np.frombuffer(payload, f"<u{row['width']}", offset=_KEY.size)
                    held.append({"doc_id": key if known else None, "start": start, "ids": ids.astype("<u4").tobytes()})
                    start += len(ids)
                    size += 4 * len(ids)
                    if size > PIECE:
                        yield pa.RecordBatch.from_pylist(held, _READ)
                        held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, _READ)


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids) from the files: ``start`` counts the ids of all documents
    before, ``ids`` are 4 bytes each. Every checksum is tested.

    A record of any length is read whole; null document ids, repeated records and documents
    with the end id alone come back as they were written; an empty manifest gives no rows."""
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each file
    placed = manifest.withColumn("before", F.coalesce(before, F.lit(0)))

    n = max(1, manifest.count())
    return placed.repartition(n).mapInArrow(lambda batches: tidily(_read_parts(batches)), "doc_id long, start long, ids binary")



def read_at(file: str, places: list[int], width: int = 2) -> list[np.ndarray]:
    """The ids of some records of one file, by their places in its index, in any order."""
    files, top = open_folder(file)
    out = []
    with files.open_input_file(f"{top}.idx") as index, files.open_input_file(f"{top}.rec") as records:
        for place in places:
            index.seek(place * _INDEX.size)
            _, offset, _ = _INDEX.unpack(index.read(_INDEX.size))
            records.seek(offset)
            payload = _payload(records, records.read(_HEAD.size))
            out.append(np.frombuffer(payload, f"<u{width}", offset=_KEY.size).astype("<u4"))
    return out


def vocabulary(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def scratch(spark: SparkSession) -> str:
    return new_folder(spark, "records")
