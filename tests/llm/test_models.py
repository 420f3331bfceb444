"""Toxicity, quality and personal data."""

import hashlib
import inspect
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daytally.llm import pii, quality, queries, toxicity
from daytally.llm.common import table
from daytally.llm.training import in_fold
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.1"


def held_out_accuracy(spark, name, label):
    labels = {r.doc_id: r[label] for r in table(spark, SF, "labels").collect()}
    rows = [r for r in queries.queries()[name](spark, SF).collect() if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    by_class = [np.mean([r.predicted == c for r in rows if labels[r.doc_id] == c]) for c in (0, 1)]
    return min(by_class)


def test_toxicity_on_held_out_labels(spark):
    assert held_out_accuracy(spark, "op7_toxicity", "toxic") > 0.85


def test_quality_on_held_out_labels(spark):
    assert held_out_accuracy(spark, "op10_quality", "quality") > 0.97


def brute_segments(places, scores, n):
    """All maximal segments of the whole sequence: the best one, then those left and right of it."""
    x = np.full(n, toxicity.DRIFT)
    x[places] = scores

    def best(a, b):
        found = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += x[j]
                if total > 0 and (found is None or total > found[0] + 1e-9):
                    found = (total, i, j)
        return found

    def split(a, b):
        found = best(a, b)
        return [] if found is None else [*split(a, found[1]), found, *split(found[2] + 1, b)]

    return split(0, n)


@pytest.mark.parametrize("seed", range(40))
def test_segments_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 60))
    places = np.sort(rng.choice(n, int(rng.integers(0, n + 1)), replace=False))
    scores = rng.normal(0.2, 1.5, len(places))
    got = toxicity.maximal_segments(places, scores)
    want = brute_segments(places, scores, n)
    assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
    assert [s for s, _, _ in got] == pytest.approx([s for s, _, _ in want])


def test_the_scan_is_linear_on_falling_totals():
    """Positive places between deeper negative ones: no candidate is ever joined."""
    steps = []

    class Counted(list):
        """Counts how often a candidate is looked at."""

        def __getitem__(self, at):
            steps[-1] += 1
            return super().__getitem__(at)

    source = inspect.getsource(toxicity.maximal_segments).replace("= []", "= Counted()", 1)
    scan = {}
    exec(source, {**vars(toxicity), "Counted": Counted}, scan)  # noqa: S102
    for n in (1000, 2000, 4000):
        steps.append(0)
        scores = np.tile([1.0, -1.5], n)
        assert len(scan["maximal_segments"](np.arange(2 * n), scores)) == n
    rising = np.concatenate([np.tile([1.0, -1.5], 2000), np.full(2000, 1.0)])
    assert toxicity.maximal_segments(np.arange(6000), rising)[-1][1:] == (4000, 5999)
    assert steps[2] <= 2.1 * steps[1] <= 4.3 * steps[0] <= 4.3 * 4 * 1000


def test_law_and_features_equal_plain_versions(spark, monkeypatch):
    rng = np.random.default_rng(5)
    words = ["good", "fine", "awful", "vile", *"abcdefgh"]
    rows = []
    for i in range(300):
        toxic = int(i % 4 == 0)
        weights = np.array([1, 1, 6 * toxic + 0.02, 6 * toxic + 0.02, *[2] * 8])
        rows.append((i, " ".join(rng.choice(words, int(rng.integers(0, 60)), p=weights / weights.sum())), toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    fitted = toxicity.fit(df.drop("toxic"), df.drop("text"), F.lit(False))
    plain = {w: h for w in words for *_, hashes, _ in toxicity.hashed_words(pa.array([w]), toxicity.BY_LETTER) for h in hashes.tolist()}
    scores = dict(zip(fitted.tokens.tolist(), fitted.scores.tolist()))
    assert {w for w in words if plain[w] in scores} >= {"awful", "vile"}
    # The scores themselves: log-odds of documents under the prior.
    sets = [(set(t.split()), y) for _, t, y in rows]
    n1, n0 = ({w: sum(w in s for s, y in sets if y == label) for w in words} for label in (1, 0))
    all1, all0, mass = sum(n1.values()), sum(n0.values()), toxicity.FLAT * len(words) + toxicity.PRIOR
    for w in words:
        prior = toxicity.FLAT + toxicity.PRIOR * (n1[w] + n0[w]) / (all1 + all0)
        odds = [np.log((n + prior) / (total + mass - n - prior)) for n, total in ((n1[w], all1), (n0[w], all0))]
        if plain[w] in scores:
            assert scores[plain[w]] == pytest.approx(odds[0] - odds[1])
    sequences = [np.array([scores.get(plain[w], toxicity.DRIFT) for w in t.split()]) for _, t, _ in rows]
    clean = np.concatenate([x for x, (*_, y) in zip(sequences, rows) if not y])
    assert np.exp(fitted.rate * clean).mean() == pytest.approx(1, abs=1e-6) or fitted.rate >= 63
    segments = [brute_segments(np.arange(len(x)), x, len(x)) for x in sequences]
    of_clean = sorted(s for own, (*_, y) in zip(segments, rows) if not y for s, _, _ in own)
    at = of_clean[(len(of_clean) - 1) // 2]
    above = sum(s >= at - 1e-9 for s in of_clean)
    assert fitted.scale == pytest.approx(above * np.exp(fitted.rate * at) / len(clean), rel=1e-6)
    x = []
    for own, sequence in zip(segments, sequences):
        normal = [fitted.rate * s - np.log(max(fitted.scale * len(sequence), 1e-9)) for s, _, _ in own]
        x.append([1, fitted.rate * max((s for s, _, _ in own), default=0), sum(v for v in normal if v > 0), np.log1p(len(sequence))])
    got = {r.doc_id: r.score for r in toxicity.score(df, fitted).collect()}
    want = 1 / (1 + np.exp(-np.clip(np.array(x) @ fitted.weights, -30, 30)))
    assert [got[i] for i in range(300)] == pytest.approx(want.tolist(), abs=1e-6)


def plain_leader(rows):
    """Follow-the-regularised-leader steps, one weight at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0)) <= quality.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * quality.L1) / ((quality.SMOOTH + np.sqrt(n[i])) / quality.RATE + quality.L2)

    for _ in range(quality.EPOCHS):
        for values, label in rows:
            w = {i: weight(i) for i in values}
            slope = 1 / (1 + np.exp(-sum(w[i] * v for i, v in values.items()))) - label
            for i, v in values.items():
                g = slope * v
                z[i] = z.get(i, 0) + g - (np.sqrt(n.get(i, 0) + g * g) - np.sqrt(n.get(i, 0))) / quality.RATE * w[i]
                n[i] = n.get(i, 0) + g * g
    return {i: weight(i) for i in z}


def test_weights_equal_a_plain_leader_however_rows_are_cut(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(0, 12)) + (" !! !!" if i % 3 else ""), int(i % 3 == 0)) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    fitted = [quality.fit(df.repartition(n).drop("quality"), df.drop("text"), F.lit(False)) for n in (4, 211)]
    assert np.array_equal(*fitted)
    draw = lambda i: int(hashlib.md5(f"{quality._SEED}:{i}".encode()).hexdigest()[:13], 16) / 2**52
    want, total = np.zeros(quality.SIZE + 1), 0
    for shard in range(quality.SHARDS):
        own = []
        for i, text, label in sorted(rows, key=lambda r: draw(r[0])):
            if int(draw(i) * quality.SHARDS) == shard:
                (places,), = quality._features(pa.array([text]))
                values = {quality.SIZE: 1.0}
                for p in places.tolist():
                    values[p] = values.get(p, 0) + 1 / np.sqrt(len(places))
                own.append((values, label))
        for i, w in plain_leader(own).items():
            want[i] += w * len(own)
        total += len(own)
    assert total == 80 and np.abs(fitted[0] - want / total).max() < 1e-4 and np.abs(want).max() > 1


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(table(spark, SF, "documents"), table(spark, SF, "labels"), in_fold(5, 0))


def test_toxic_passages_are_where_the_words_are(spark, model):
    rng = random.Random(2)
    text = f"{prose(rng, 200)} idiot moron {prose(rng, 5)} scum trash loser {prose(rng, 200)}"
    row = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert row.score > 0.5 and [(p.first, p.last) for p in row.passages] == [(200, 209)]


def test_scores_of_awkward_rows(spark, awkward, empty, model):
    got = toxicity.score(awkward, model).collect()
    assert len(got) == awkward.count() and all(0 <= r.score < 0.5 for r in got)
    assert len({r.score for r in got if r.doc_id in (4, 5)}) == 1
    kept = toxicity.clean(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert toxicity.score(empty, model).isEmpty() and toxicity.clean(empty, model).isEmpty()
    weights = quality.fit(table(spark, SF, "documents"), table(spark, SF, "labels"), in_fold(3, 1), rows=500)
    got = quality.score(awkward, weights).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.score(empty, weights).isEmpty()


def test_no_labels_give_one_half(spark, awkward):
    labels = spark.createDataFrame([(None, 1, 1), (4, None, None)], "doc_id long, toxic int, quality int")
    blank = toxicity.fit(awkward, labels, F.lit(False))
    assert {r.score for r in toxicity.score(awkward, blank).collect()} == {0.5}
    weights = quality.fit(awkward, labels, F.lit(False))
    assert {r.score for r in quality.score(awkward, weights).collect()} == {0.5}


def test_held_out_labels_are_not_used(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(in_fold(3, 1, "doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = quality.fit(docs, labels, in_fold(3, 1), rows=600)
    assert np.array_equal(a, quality.fit(docs, turned, in_fold(3, 1), rows=600))


#: The contract's own patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        doubled = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(digits[::-1])]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute_spans(text):
    return [(k, m.start(), m.end()) for k in PATTERNS for m in re.finditer(PATTERNS[k], text or "") if passes(k, m.group())]


def test_base_spans_equal_brute_force(spark, awkward):
    rng = random.Random(5)
    pieces = ["a", "b.c", "@", ".", "-", "1", "23", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (456) 555-2186", "+", "(", ")", " ", "_", "x@y.z", "é", "192.168.1.300", "10.0.0.1", "000.0000255.01.2", ".5", "@@", "\n", "%", "\U0001f600", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))) for i in range(1500)]
    rows += [(5000, None), (5001, "1" * 5000 + " " + "a" * 5000 + " " + "1." * 3000 + " +" + "+1(" * 3000), (5002, "a@b" + ".c" * 3000 + " " + "12 " * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(awkward.select((F.col("doc_id") + 10**6).alias("doc_id"), "text"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = pii.find(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None or r.doc_id == 10**6 + 11:
            continue
        base = [(s.kind, s.start, s.end) for s in r.spans if s.kind != pii.TERM]
        assert base == brute_spans(texts[r.doc_id]), r.doc_id


def test_query_digest(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in table(spark, d, "documents").collect()}
    for r in queries.op8_pii(spark, d).collect():
        want = brute_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == w[0] for w in want) for k in PATTERNS)


def test_terms_that_give_a_value_away(spark):
    rng = random.Random(1)
    rows = [(n, f"{prose(rng, 30)} please ask Zanzibar at zz@mail.example.org {prose(rng, 30)}") for n in range(6)]
    rows += [(100 + n, f"{prose(rng, 30)} please ask for u{n}@mail.example.org {prose(rng, 30)}") for n in range(60)]
    rows += [(300 + n, f"please ask {prose(rng, 40)}") for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts, found = dict(rows), {}
    for r in pii.find(docs).collect():
        for s in r.spans:
            if s.kind == pii.TERM:
                found.setdefault(texts[r.doc_id][s.start : s.end].lower(), set()).add(r.doc_id)
    assert found["zanzibar"] == set(range(6)) and "please" not in found and "ask" not in found
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "Zanzibar" not in clean[0] and "[EMAIL]" in clean[0] and "zz@" not in clean[0]
    assert clean[300] == texts[300]


def term_spans(docs):
    """{doc_id: the terms that are marked}, and the places."""
    texts = {r.doc_id: r.text for r in docs.collect()}
    return {r.doc_id: [(texts[r.doc_id][s.start : s.end].lower(), s.start) for s in r.spans if s.kind == pii.TERM] for r in pii.find(docs).collect()}


def test_terms_far_from_a_value_and_beside_failing_matches(spark):
    rng = random.Random(7)
    rows = [(n, f"Zanzibar {prose(rng, 40)} or ann@x.org {prose(rng, 300)} zanzibar") for n in range(5)]
    rows += [(50 + n, f"{prose(rng, 9)} ask Ruritania, ext 10, card 4111 1111 1111 1111 {prose(rng, 9)}") for n in range(5)]
    rows += [(100 + n, f"{prose(rng, 30)} ask card b{n}@x.org ext {prose(rng, 30)}") for n in range(120)]
    found = term_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    for n in range(5):
        assert [t for t, _ in found[n]].count("zanzibar") == 2
        assert "ruritania" in [t for t, _ in found[50 + n]]


def test_terms_equal_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"w{a}{b}" for a in "abcdefgh" for b in "xyzuv"]
    letters = lambda w: w.replace("w", "wo")
    rows = []
    for n in range(150):
        value = rng.choice([f"u{n % 7}@a.org", f"u{n % 7}@a.org", "10.0.0.%d" % (n % 3), ""])
        own = [letters(rng.choice(vocabulary)) for _ in range(rng.randint(0, 12))] + ([f"Near{'abcdefg'[n % 7]}"] if "@" in value else [])
        rng.shuffle(own)
        rows.append((n, " ".join([*own, value, *(letters(rng.choice(vocabulary)) for _ in range(rng.randint(0, 5)))])))
    rows += [(200 + n, rows[n][1]) for n in range(20)]
    terms = {n: set(re.findall(r"[^\W\d_]{3,}", t.lower())) for n, t in rows}
    values, contexts = {}, {}
    for n, t in rows:
        matches = {k: [*re.finditer(PATTERNS[k], t)] for k in PATTERNS}
        for k, a, b in brute_spans(t):
            i = [m.start() for m in matches[k]].index(a)
            left = t[matches[k][i - 1].end() if i else 0 : a][-64:]
            right = t[b : matches[k][i + 1].start() if i + 1 < len(matches[k]) else None][:64]
            values.setdefault(f"{k}:{t[a:b].lower()}", set()).add(n)
            contexts.setdefault((f"{k}:{t[a:b].lower()}", n), (left, right))
    n_term = {w: sum(w in own for own in terms.values()) for own in terms.values() for w in own}
    want = {n: set() for n, _ in rows}
    for value, holders in values.items():
        for w in set().union(*(terms[n] for n in holders)):
            both = [n for n in holders if w in terms[n]]
            if len({contexts[value, n] for n in both}) < pii.SUPPORT:
                continue
            share = np.log(len(both) * len(rows) / (n_term[w] * len(holders))) / np.log(len(rows) / len(holders))
            if share >= pii.GENERALISE - 1e-12:
                for n in both:
                    want[n].add(w)
    found = term_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sum(map(len, want.values())) > 50
    for n, t in rows:
        places = [(m.group().lower(), m.start()) for m in re.finditer(r"[^\W\d_]{3,}", t) if m.group().lower() in want[n]]
        assert sorted(found[n]) == sorted(places), n


def test_sanitised_awkward_rows(awkward, empty):
    got = pii.sanitise(awkward)
    assert got.columns == awkward.columns and got.count() == awkward.count()
    by_id = {r.doc_id: r.text for r in got.collect()}
    assert by_id[9] == "[EMAIL] or [PHONE], or [IP], or [CARD]" and by_id[1] is None
    assert pii.sanitise(empty).isEmpty() and pii.find(empty).isEmpty()
