"""Vector codes, Merkle manifests and packing, held against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daytally.llm import bpe, merkle, packing, part_codes
from daytally.llm.known import HashedIds
from tests.llm.test_tokens import texts

# --- vector codes


def brute_codes(rows, parts=part_codes.PARTS):
    """{row number: (code, error)} and the codebooks of ``rows``, (key, vector), in key order."""
    points = np.floor(256 * np.array([v for _, v in rows], float)).astype(np.int64).reshape(len(rows), parts, -1).transpose(1, 0, 2)
    books = points[:, : part_codes.ENTRIES].copy()

    def nearest():
        d = ((points[:, :, None] - books[:, None]) ** 2).sum(3)
        return d.argmin(2), d.min(2)

    for _ in range(part_codes.ROUNDS):
        own, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                if (own[p] == e).any():
                    books[p, e] = points[p][own[p] == e].sum(0) // (own[p] == e).sum()
    own, d = nearest()
    return ["".join(f"{e:02x}" for e in code) for code in own.T], d.sum(0).tolist(), books


@pytest.mark.parametrize("n", [1, 2, 63, 300, 2500])
def test_codes_equal_brute_force(spark, monkeypatch, n):
    monkeypatch.setattr(part_codes, "CHUNK", 200)
    rng = np.random.default_rng(n)
    centers = rng.normal(size=(9, 32))
    vectors = (centers[rng.integers(0, 9, n)] + rng.normal(scale=0.05, size=(n, 32))).astype(np.float32).round(2)
    keys = rng.permutation(n)
    rows = sorted((int(k), [float(x) for x in v]) for k, v in zip(keys, vectors))
    df = spark.createDataFrame([(k, v, k % 3 or None) for k, v in rows], "vec_id long, embedding array<float>, label int").repartition(3)
    codes = part_codes.compress(df)
    rows = [(k, np.float32(v)) for k, v in rows]
    text, error, books = brute_codes(rows)
    assert (codes.codebooks == books).all()
    assert {r.vec_id: (r.code, r.error) for r in codes.rows.collect()} == {k: (c, e) for (k, _), c, e in zip(rows, text, error)}
    sums = {r.label: r.label_error for r in part_codes.with_label_error(codes).collect()}
    assert sums == {x: sum(e for (k, _), e in zip(rows, error) if (k % 3 or None) == x) for x in sums}


def test_trees_own_whole_balls_of_clustered_points_and_agree_on_ties():
    rng = np.random.default_rng(1)
    for spread, n in ((0, 400), (1, 700), (30, 1024)):
        centers = rng.integers(-10_000, 10_000, (16, 8, 4))
        points = centers[:, rng.integers(0, 8, n)] + rng.integers(-spread, spread + 1, (16, n, 4))
        books = np.concatenate([centers, centers, rng.integers(-10_000, 10_000, (16, 20, 4))], 1)
        forest = part_codes.plant(points)
        owned, owner, place, entry, _ = part_codes.assign(forest, points, books)
        ordered = np.full(16 * n, -1)
        ordered[part_codes._ranges(forest.low[owned], forest.high[owned])] = np.repeat(owner, (forest.high - forest.low)[owned])
        ordered[place] = entry
        code = np.empty((16, n), np.int64)
        np.put_along_axis(code, forest.order.astype(np.int64), ordered.reshape(16, n), 1)
        assert (code == ((points[:, :, None] - books[:, None]) ** 2).sum(3).argmin(2)).all()
        # Without the doubled entries nearly all balls are owned whole.
        owned, _, place, _, _ = part_codes.assign(forest, points, books[:, 8:])
        assert len(place) < 16 * n / 10
        assert (forest.total[:16] == points.sum(1)).all()


def test_codes_of_awkward_vectors(spark):
    good = [0.5] * 16
    rows = [(1, None, 1, 0.5), (2, [], 1, 0.5), (3, good[:-1] + [None], 1, 0.5), (4, good[:-1] + [float("nan")], 1, 0.5),
            (5, good[:-1] + [float("inf")], 1, 0.5), (6, good, 1, 0.5), (6, good, None, 0.5), (None, [-0.001] * 16, None, None), (7, good * 2, 1, 0.5), (8, good[:7], 1, 0.5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, error double")
    codes = part_codes.compress(df)
    got = part_codes.with_label_error(codes).select("vec_id", "label", "code", "error", "label_error").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(6, 1, "00" * 16, 0, 0), (6, None, "00" * 16, 0, 0), (None, None, "02" * 16, 0, 0)], key=repr)
    assert codes.codebooks[:, :, 0].tolist() == [[128, 128, -1]] * 16
    none = part_codes.compress(df.filter("1 = 0"))
    assert none.rows.isEmpty() and none.codebooks.size == 0 and len(none.digest()) == 64
    with pytest.raises(Exception, match="too large"):
        part_codes.compress(spark.createDataFrame([(1, [1e30] * 16, 1)], "vec_id long, embedding array<double>, label int"))


# --- manifests


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_manifest(rows, changed):
    """(key, leaf, subroot, root, proof, folded root) of rows (doc_id, source, lang, n_chars, text)."""

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
        return levels

    def beside(levels, i):
        for level in levels[:-1]:
            yield (level[i - 1], "") if i % 2 else ("", level[i + 1] if i + 1 < len(level) else "")
            i //= 2

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row, sha(*map(framed, row))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for name in names:
        groups[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = [climb([h for _, h in groups[name]]) for name in names]
    top = climb([t[-1][0] for t in trees])
    out = []
    for g, name in enumerate(names):
        for i, (row, leaf) in enumerate(groups[name]):
            path = [*beside(trees[g], i), *beside(top, g)]
            digest = sha(*map(framed, changed(row)))
            for left, right in path:
                digest = sha(left, digest, right)
            out.append((row[0], leaf, trees[g][-1][0], top[-1][0], sha(*(a + b for a, b in path)), digest))
    return out


def tampered(row):
    doc_id, source, lang, n_chars, text = row
    picked = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
    return (doc_id, source, lang, n_chars + picked if n_chars is not None else None, text)


def manifest_of(df):
    columns = F.struct(*[(F.col(c) + 1 if c == "n_chars" else F.col(c)).alias(c) for c in merkle.COLUMNS])
    rows = merkle.manifest(df, F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, columns))
    return merkle.verified(rows).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root").collect()


@pytest.mark.parametrize("levels", [2, 8])
def test_manifests_equal_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 1 << levels)
    rng = random.Random(levels)
    rows = [(rng.randrange(40), rng.choice([None, "s"]), rng.choices([None, "", "de", "é", "one"], [1, 9, 30, 2, 0.3])[0], rng.choice([None, 5]), rng.choice([None, "", "x", "漢字"])) for _ in range(300)]
    rows += [(i, "s", f"own{i:02}", i, "t") for i in range(21)] + [(7, "s", "de", 1, "same")] * 20
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert sorted(map(tuple, manifest_of(df)), key=repr) == sorted(brute_manifest(rows, tampered), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 256, 257])
def test_manifests_of_few_rows(spark, n):
    rows = [(i, "s", "en", 3, "abc") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = manifest_of(df)
    assert sorted(map(tuple, got), key=repr) == sorted(brute_manifest(rows, tampered), key=repr)
    assert all((r.folded_root == r.root) == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0) for r in got)


def test_manifests_of_awkward_rows(spark, awkward):
    """Nulls, long texts, ties and columns named like the operator's own."""
    rows = [(r.doc_id, r.source, r.key, r.size, r.text) for r in awkward.collect()]
    names = ("doc_id", "source", "key", "size", "text")
    clash = awkward.withColumns({"digest": F.lit("d"), "place": F.lit(1), "leaf": F.lit("l"), "group": F.lit(1), "n": F.lit(3)})
    got = merkle.verified(merkle.manifest(clash, columns=names, group="key")).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_manifest(rows, lambda r: r), key=repr)


# --- packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(packing.vocabulary())


@settings(max_examples=300, deadline=None)
@given(texts, texts)
def test_pieces_of_the_library_equal_whole_texts(library, a, b):
    own = packing.PieceEncoder(packing.vocabulary())
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array([a, None, b, f"{a} x.{b}", f"{b}\nx'll{a}"])], names=["row", "text"])
    found = {k: ids[s:e].tolist() for keys, ids, at in bpe._encode_batches(iter([batch]), own) for k, s, e in zip(keys.to_pylist(), at, at[1:])}
    assert found == {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(batch.column(1).to_pylist())}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=60))
def test_sequences_hold_each_token_once_and_are_full(lengths):
    sequences = packing.pack_pool(lengths)
    seen = sorted((doc, start, start + n) for s in sequences for n, doc, start in s)
    for doc, length in enumerate(lengths):
        own = [(a, b) for d, a, b in seen if d == doc]
        assert own[0][0] == 0 and own[-1][1] == length and all(x[1] == y[0] for x, y in zip(own, own[1:]))
    sizes = [sum(p[0] for p in s) for s in sequences]
    tail = [n for n in sizes if n not in packing.SIZES]
    assert all(n & (n - 1) == 0 for n in sizes) and len(set(tail)) == len(tail) and max(sizes, default=1) <= 2048
    groups = packing.steps(sequences)
    for group in set(groups):
        own = [n for n, g in zip(sizes, groups) if g == group]
        assert sum(own) <= packing.STEP_TOKENS and (len(set(own)) == 1 or set(own) <= set(tail))
    for size in packing.SIZES:
        held = [sum(g == group for g, n in zip(groups, sizes) if n == size) for group in {g for g, n in zip(groups, sizes) if n == size}]
        assert not held or max(held) - min(held) <= 1


def test_gaps_of_long_windows_take_shorter_tiers_first():
    [first, *_] = packing.pack_pool([2000, 1500, 48, 300, 540, 600])
    assert first == [(2000, 0, 0), (48, 2, 0)]
    second = packing.pack_pool([1500, 540, 600, 300])[0]
    assert second == [(1500, 0, 0), (540, 1, 0), (8, 3, 0)]  # the longest that fits, then a cut


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2)), max_size=8), max_size=9))
def test_pieces_of_one_slot_are_told_apart(batches):
    known = HashedIds("<u4", 8)
    for batch in batches:
        hashes = np.array([a << 40 | 29 + b for a, b in batch], np.uint64)  # the last slots, and on from the first
        known.make_room()
        places = known.places(hashes)
        missing = np.flatnonzero(places < 0)
        new, which = np.unique(hashes[missing], return_inverse=True)
        own = [[int(h >> np.uint64(40))] * int(h & np.uint64(3)) for h in new]
        places[missing] = known.learn(new, np.array([*map(len, own)], np.int32), np.array(sum(own, []), "<u4"))[which]
        assert (known.places(hashes) == places).all()
        ids, before = known.ids_of(places)
        assert [ids[s:e].tolist() for s, e in zip(before, before[1:])] == [[int(h >> np.uint64(40))] * int(h & np.uint64(3)) for h in hashes]


def test_tasks_of_a_worker_know_what_earlier_ones_learned(library, monkeypatch):
    asked, ids = [], packing.PieceEncoder._ids
    monkeypatch.setattr(packing.PieceEncoder, "_ids", lambda self, texts: asked.extend(texts) or ids(self, texts))
    rows = ["one two, three\nfour", None, "two  1\u3000x<|endoftext|>", "é two, x.y"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(rows)], names=["row", "text"])
    packing.encoder.cache_clear()
    for learned in (True, False):
        asked.clear()
        found = [row for b in packing._tokens(iter([batch]), packing.vocabulary(), 1, 2) for row in b.to_pylist()]
        assert bool("".join(asked)) == learned
        assert {r["row"]: np.frombuffer(r["ids"], "<u2").tolist() for r in found} == {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(rows)}
    assert [*packing._packed(iter([]), 2)] == []
    assert packing.encoder.cache_info().currsize == 0


def test_packed_documents_come_back_whole(spark, awkward, empty, library, monkeypatch):
    awkward = awkward.withColumns({"start": F.lit(1), "pool": F.lit(2), "ids": F.lit(b"x"), "place": F.lit(0), "text_": F.lit(0)})
    for pool_docs, pool_tokens in ((4096, 1 << 22), (3, 50)):
        monkeypatch.setattr(packing, "POOL_DOCS", pool_docs)
        monkeypatch.setattr(packing, "POOL_TOKENS", pool_tokens)
        got = packing.pack(awkward.repartition(3), packing.vocabulary()).collect()
        assert packing.pack(awkward, packing.vocabulary()).exceptAll(spark.createDataFrame(got, packing.pack(empty, packing.vocabulary()).schema)).isEmpty()
        by_sequence = {}
        for r in got:
            assert len(r.ids) == 4 * r.length
            by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for pieces in by_sequence.values():
            pieces.sort()
            assert [o for o, _ in pieces] == np.cumsum([0, *(n for _, n in pieces)])[:-1].tolist()
            assert sum(n for _, n in pieces).bit_count() == 1
        # Repeated rows cannot be told apart by id: their pieces come in as many copies.
        want = {}
        for r in awkward.collect():
            want.setdefault(r.doc_id, []).append(library.encode(r.text or "", add_special_tokens=False).ids + [1])
        for key, documents in want.items():
            own = [r for r in got if r.doc_id == key]
            assert sum(r.length for r in own) == sum(map(len, documents))
            assert {r.doc_tokens for r in own} == set(map(len, documents))
            if len(documents) == 1:
                whole = b"".join(r.ids for r in sorted(own, key=lambda r: r.start))
                assert np.frombuffer(whole, "<u4").tolist() == documents[0]
    assert packing.pack(empty, packing.vocabulary()).isEmpty()
