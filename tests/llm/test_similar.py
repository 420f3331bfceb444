"""N-gram join, shared passages and nearest neighbours against brute force."""

import glob
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daytally.llm import knn, ngram_join, passages
from daytally.llm.common import FILES_A_CORE, LEAST_FILES, gathered, written
from daytally.llm.components import components
from tests.llm.conftest import bag, prose


def shingle_set(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute_components(rows, k=4, percent=85):
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return sorted((i, len(s), find(i)) for i, s in sets)


def family(rng, n, size, most):
    """Texts that differ from one another in up to ``most`` words each."""
    base = prose(rng, size).split()
    out = []
    for _ in range(n):
        words = base.copy()
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(size)] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = [prose(rng, rng.choice([0, 1, 3, 4, 5, 9, 40, 150])) for _ in range(60)]
    texts += family(rng, 70, 120, 2) + family(rng, 40, 60, 3) + family(rng, 8, 400, 9) + family(rng, 30, 12, 1)
    shared = prose(rng, 45)
    texts += [f"{shared} {prose(rng, rng.randint(1, 60))}" for _ in range(60)]
    texts += [texts[70]] * 30 + [None, "", " ", "One two THREE", "one TWO three", "one two"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("changed", [{}, {"SHORT_LIST": 3, "BLOCK": 7, "BLOCK_BYTES": 3000}, {"SHORT_LIST": 4, "ROWS": 50, "COUNTS": 3}])
def test_components_equal_brute_force(spark, monkeypatch, seed, changed):
    for name, value in changed.items():
        monkeypatch.setattr(ngram_join, name, value)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert bag(ngram_join.join(docs)) == sorted(brute_components(rows), key=repr)


def test_split_lists_give_the_same(spark):
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert bag(ngram_join.join(docs, split_at=10)) == sorted(brute_components(rows), key=repr)


def test_other_sizes_and_thresholds(spark):
    rows = corpus(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sim = ngram_join.Similarity(words=5, percent=80)
    assert bag(ngram_join.join(docs, sim)) == sorted(brute_components(rows, 5, 80), key=repr)


def test_join_of_awkward_rows(awkward, empty):
    got = ngram_join.join(awkward).collect()
    assert len(got) == awkward.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[5].component_id == 4 and by_id[8].component_id == 6 and by_id[3].n_shingles == 0
    kept = ngram_join.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {None, 1, 2, 3, 4, 6, 9, 10, 11, 2**62}
    assert ngram_join.join(empty).isEmpty() and ngram_join.one_of_each(empty).isEmpty()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (9, None), (3, 2), (2, 3)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)} | {2: 2, 3: 2}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def covered(rows, doc):
    return {w for r in rows if r.doc_id == doc for w in range(r.start, r.end)}


def test_shared_passages_are_found_and_clean_documents_left_alone(spark):
    rng = random.Random(4)
    docs, want = {}, {}
    for n in range(40):
        docs[n] = prose(rng, rng.choice([0, 3, 60, 300]))
    for n in range(60):
        size = rng.choice([51, 55, 70, 120])
        passage, twice = prose(rng, size), 2 + n % 3
        for c in range(twice):
            before = rng.choice([0, 1, 30, 200])
            doc = 100 + 10 * n + c
            docs[doc] = f"{prose(rng, before)} {passage.upper() if c else passage}\n{prose(rng, rng.choice([0, 5, 90]))}"
            want[doc] = set(range(before, before + size))
    short = prose(rng, 46)
    for n in range(5):
        docs[1000 + n] = f"{prose(rng, 100)} {short} {prose(rng, 100)}"
    docs[2000] = docs[2001] = "same " * 80
    want[2000] = want[2001] = set(range(80))
    rows = passages.passages(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows} == want.keys()
    for doc, words in want.items():
        found = covered(rows, doc)
        assert len(found & words) >= 51 and len(found - words) <= 4
    first = {r.doc_id: r.removed for r in rows}
    assert not first[100] and first[101] and not first[2000] and first[2001]


def test_nearly_equal_passages_are_clustered(spark):
    rng = random.Random(6)
    docs = []
    for n in range(40):
        words = prose(rng, 120).split()
        changed = words.copy()
        changed[rng.choice([40, 60, 80])] = "other"
        docs += [(2 * n, " ".join(words)), (2 * n + 1, f"{prose(rng, 20)} {' '.join(changed)}")]
    rows = passages.passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows} >= {2 * n + 1 for n in range(40)}


def paragraphs_of(texts):
    """{class: set of shingles} by the module's own paragraphs."""
    return {int(k): frozenset(own.tolist()) for _, _, place, kind, shingles, *_ in passages._paragraphs(pa.array(texts)) for k, own in zip(kind.view(np.int64), passages._own(shingles, place))}


def test_anchors_of_all_texts_at_once_are_those_of_each():
    rng = np.random.default_rng(16)
    lengths = np.concatenate([rng.integers(-3, 3 * passages.STRETCH, 300), [passages.STRETCH, passages.STRETCH + 1, 5000]])
    starts = np.cumsum(np.maximum(lengths, 0) + 24) - np.maximum(lengths, 0)
    ranks = rng.choice(rng.integers(1, 1 << 62, 400).astype(np.uint64), starts[-1] + 5000)
    want = []
    for i, (a, n) in enumerate(zip(starts, lengths)):
        own = ranks[a : a + max(n, 0)].tolist()
        if 0 < n <= passages.STRETCH:
            want.append((i, a + own.index(min(own))))
        windows = [(j, min(own[j : j + passages.STRETCH])) for j in range(n - passages.STRETCH + 1)] if n > passages.STRETCH else []
        want += sorted({(i, a + k) for j, least in windows for k in range(j, j + passages.STRETCH) if own[k] == least})
    text, place = passages._anchors(ranks, starts, starts + lengths)
    assert list(zip(text.tolist(), place.tolist())) == want


def cluster_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    return {r["class"]: r.cluster for r in passages.clusters(rows, passages.occurrences(rows)).collect()}


def test_similar_paragraphs_of_different_documents_meet(spark):
    rng = random.Random(11)
    texts, pairs = [], []
    for _ in range(100):
        words = prose(rng, 150).split()
        changed = words.copy()
        for i in rng.sample(range(150), 2):
            changed[i] = f"new{rng.randrange(10**6)}"
        two = [" ".join(words), " ".join(changed)]
        texts += two
        x, y = map(paragraphs_of, ([t] for t in two))
        pairs += [(a, b) for a in x for b in y if a != b and 5 * len(x[a] & y[b]) >= 4 * len(x[a] | y[b])]
    found = cluster_of(spark, texts)
    assert len(pairs) > 50
    assert sum(a in found and found[a] == found.get(b) for a, b in pairs) >= 0.9 * len(pairs)


def test_similar_paragraphs_around_a_very_common_phrase_meet(spark):
    rng = random.Random(12)
    phrases = [prose(rng, 5) for _ in range(20000)]
    least = [int((passages._runs(next(passages.hashed_words(pa.array([p])))[2], 5, passages._ODD[0]) * passages._ODD[2])[0]) for p in phrases]
    phrase = phrases[least.index(min(least))]
    texts = []
    for n in range(300):
        before, after = prose(rng, 10), prose(rng, 9)
        texts += [f"{before} {phrase} {after} one{n}", f"{before} {phrase} {after} two{n}"]
    found = cluster_of(spark, texts)
    clusters = [{found.get(k) for k in paragraphs_of(texts[2 * n : 2 * n + 2])} for n in range(300)]
    assert all(len(c) == 1 and None not in c for c in clusters) and len(set.union(*clusters)) == 300


def test_a_passage_of_very_many_documents_is_sent_on_once_a_run(monkeypatch):
    rng = random.Random(13)
    common = prose(rng, 60)
    texts = pa.array([f"{prose(rng, 20)} {common}" for _ in range(500)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(500)), texts], names=["id", "text"])
    rows = [(r["band"], r["class"]) for out in passages._banded(iter([batch, batch])) for r in out.to_pylist()]
    assert len(rows) == len(set(rows)) >= 500


@pytest.mark.parametrize("held", [16, 400, 1 << 16])
def test_long_bands_give_the_same_pairs_in_memory_and_by_lists(monkeypatch, held):
    monkeypatch.setattr(passages, "HELD_LIST", held)
    rng = np.random.default_rng(15)
    band = np.repeat(np.arange(40), rng.integers(1, 30, 40)).tolist() + [77] * 300 + [78] * 500
    band = passages.mix(np.array(band, np.uint64)).view(np.int64).tolist()
    base = rng.integers(-(1 << 62), 1 << 62, 60)
    marks = rng.choice(base, len(band)) ^ (1 << rng.integers(0, 62, len(band)))
    kind = rng.permutation(len(band))
    rows = sorted(zip(band, kind.tolist(), marks.tolist()))
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["a", "b", "marks"])
    out = [r for b in passages._collisions(iter([batch(rows)])) for r in b.to_pylist()]
    got = [(r["a"], r["b"]) for r in out if r["marks"] is None]
    lists = sorted((r["a"], r["b"], r["marks"]) for r in out if r["marks"] is not None)
    assert bool(lists) == (held < 500)
    assert len(got) == len(set(got))
    if lists:
        got += [(r["a"], r["b"]) for b in passages._met(iter([batch(lists)])) for r in b.to_pylist()]
    want = {
        frozenset((x, y))
        for (p, x, m), (q, y, n) in itertools.combinations(rows, 2)
        if p == q and ((m ^ n) & (1 << 64) - 1).bit_count() <= passages.APART
    }
    assert {frozenset(p) for p in got} == want and len(want) > 500


def test_repetitive_passages_are_found_whole(spark):
    rng = random.Random(14)
    line = prose(rng, 10)
    texts = ["same " * 80, "same " * 2000, f"{line} " * 200]
    for text, ends in zip(texts, (0, 0, 10)):
        (_, _, place, *_), = passages._paragraphs(pa.array([text]))
        n = len(text.split())
        assert place[0] <= ends and n - place[-1] - passages.WINDOW <= ends
        assert (np.diff(place) <= passages.WINDOW).all() and len(place) <= n // 10
    docs = spark.createDataFrame([(10 * n + c, t) for n, t in enumerate(texts) for c in (0, 1)], "doc_id long, text string")
    rows = passages.passages(docs).collect()
    assert all(len(covered(rows, 10 * n + c)) >= len(t.split()) - ends for n, (t, ends) in enumerate(zip(texts, (0, 0, 20))) for c in (0, 1))


def test_removal_leaves_one_copy(spark, awkward, empty):
    rng = random.Random(8)
    passage, a, b, c = prose(rng, 90), prose(rng, 30), prose(rng, 30), prose(rng, 30)
    docs = spark.createDataFrame([(1, f"{a} {passage} {b}", "x"), (2, f"{c} {passage}", "y"), (3, None, "z")], "doc_id long, text string, row string")
    got = {r.doc_id: r for r in passages.remove(docs).collect()}
    assert got[1].text == f"{a} {passage} {b}" and got[3].text is None and got[2].row == "y"
    left = got[2].text.split()
    assert left[:30] == c.split() and len(left) < 75
    assert passages.remove(awkward).columns == awkward.columns
    assert passages.remove(awkward).count() == awkward.count()
    assert passages.remove(empty).isEmpty() and passages.passages(empty).isEmpty()
    assert {r.doc_id for r in passages.passages(awkward).collect()} == {6, 7, 8}


def brute_nearest(rows, k, every):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            kept[i] = np.array(v, float)
    out = []
    for q in kept:
        if q % every == 0:
            near = sorted((float(np.sqrt(((kept[q] - v) ** 2).sum())), i) for i, v in kept.items() if i != q and len(v) == len(kept[q]))
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near[:k])]
    return out


@pytest.mark.parametrize("blocks", [(1024, 2048, 1 << 24), (3, 7, 4000)])
def test_neighbours_equal_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(knn, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(knn, "CANDIDATE_BLOCK", blocks[1])
    monkeypatch.setattr(knn, "GROUP_BYTES", blocks[2])
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(500)]
    rows += [(i, rows[i % 3][1]) for i in range(500, 620)]  # very common vectors, queries among them
    rows += [(i, [1.0, 2.0]) for i in range(1000, 1005)] + [(2000, [1e30] * 16), (2010, [1e-30] * 16), (2020, [-0.0] * 15 + [1.0])]
    rows += [(3000, None), (3010, [0.0] * 16), (3020, [float("nan")] * 16), (3030, [None] + [1.0] * 15), (3040, [float("inf")] * 16), (None, [1.0] * 16), (20, rows[20][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = knn.nearest(table, F.col("id") % 10 == 0).collect()
    stored = [(r.vec_id, r.embedding) for r in table.collect()]
    want = brute_nearest(stored, 10, 10)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(w[:3] for w in want)
    scores = {w[:3]: w[3] for w in want}
    assert all(r.score == pytest.approx(scores[r.query_id, r["rank"], r.vec_id], rel=1e-14) for r in got)


def test_blocks_of_queries_are_grouped_by_size(spark, monkeypatch):
    blocks = spark.createDataFrame([(n, b"c" * 16, b"v" * 128, 2) for n in (1, 2, 5, 9, 70)], "block long, codes binary, vectors binary, n int")
    one = 16 + 128 + 40 * 2
    for room, want in [(one, [(1, 1), (2, 2), (5, 5), (9, 9), (70, 70)]), (2 * one, [(1, 2), (5, 9), (70, 70)]), (1, 5), (9 * one, [(1, 70)])]:
        monkeypatch.setattr(knn, "GROUP_BYTES", room)
        got = knn._groups(blocks)
        assert got == want or len(got) == want


def test_few_or_no_vectors(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [4.0])], "vec_id long, embedding array<double>")
    assert bag(knn.nearest(table, F.col("id") == 0)) == [(0, 1, 1, 1.0), (0, 2, 2, 3.0)]
    assert knn.nearest(table.filter("1 = 0"), F.col("id") == 0).isEmpty()
    assert knn.nearest(table.filter("vec_id = 0"), F.col("id") == 0).isEmpty()


def test_bounds_hold():
    x = np.random.default_rng(1).normal(size=(200, 32)) * np.logspace(-3, 3, 200)[:, None]
    codes, scale, norm, error = knn.quantised(x)
    near = codes * scale[:, None]
    true = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    seen = np.sqrt(((near[:, None] - near[None]) ** 2).sum(-1))
    assert (np.abs(true - seen) <= (error[:, None] + error[None]) * (1 + 1e-9) + 1e-12).all()


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}


def test_shuffles_of_a_written_table_leave_no_files(spark):
    before = _shuffle_files(spark)
    made = written(spark.range(1000, numPartitions=8).repartition(7, "id").groupBy((F.col("id") % 10).alias("g")).count(), "made")
    deadline = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < deadline:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert sorted(map(tuple, made.collect())) == [(g, 100) for g in range(10)]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_gathered_tables_have_few_files(spark):
    many = spark.range(10_000, numPartitions=400)
    assert len(written(many, "many").inputFiles()) == 400
    few = gathered(many, "few")
    assert len(few.inputFiles()) == max(LEAST_FILES, FILES_A_CORE * spark.sparkContext.defaultParallelism) < 100
    assert (few.count(), few.agg(F.sum("id")).first()[0]) == (10_000, sum(range(10_000)))
    links = spark.range(600).select(F.col("id").alias("a"), (F.col("id") + 600).alias("b")).repartition(300, "a")
    assert len(components(links).inputFiles()) <= LEAST_FILES
