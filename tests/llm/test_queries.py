"""Registered queries against their SQL, and the pipeline against its stages."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from daytally.llm import oracle, queries
from daytally.llm.common import table
from tests.compare import differences, duck
from tests.llm.conftest import bag, prose
from tests.llm.test_similar import brute_components


@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_query_equals_sql(spark, sf_dir, name):
    only_spark, only_duck = differences(queries.queries()[name](spark, sf_dir), duck(sf_dir), oracle.oracle_sql()[name])
    assert not only_spark and not only_duck


def test_all_are_registered():
    names = entry.queries().keys()
    assert {f"op{n}_" for n in range(1, 14)} == {n.split("_")[0] + "_" for n in names if n.startswith("op")}
    assert "pipeline" in names and oracle.oracle_sql().items() <= entry.oracle_sql().items()


def test_stages_of_the_pipeline(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert [*stages] == ["toxicity", "exact_dedup", "ngram_join", "mixing", "bpe"]
    unique = stages["exact_dedup"](spark, docs, sf_dir)
    rows = docs.collect()
    keep = {}
    for r in rows:
        keep[r.text] = max(keep.get(r.text, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(keep.values())
    single = stages["ngram_join"](spark, docs, sf_dir)
    firsts = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in rows])}
    assert {r.doc_id for r in single.collect()} == firsts
    for name in ("toxicity", "exact_dedup", "ngram_join", "mixing"):
        assert stages[name](spark, docs, sf_dir).columns == docs.columns


def test_near_copies_go_by_five_words_and_four_fifths(spark, sf_dir):
    rng = random.Random(5)
    words = prose(rng, 1000).split()
    changed = [f"new{i}" if i % 46 == 45 else w for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(changed)), (3, prose(rng, 100))]
    firsts = {c for _, _, c in brute_components(rows, 5, 80)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert firsts == {1, 3} and {c for _, _, c in brute_components(rows)} == {1, 2, 3}
    assert {r.doc_id for r in dict(corpus_pipeline.STAGES)["ngram_join"](spark, docs, sf_dir).collect()} == firsts


def test_pipeline_is_its_stages_in_turn(spark, sf_dir):
    whole = corpus_pipeline.run(spark, sf_dir)
    assert whole.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    texts = {r.doc_id: r.sha for r in table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha")).collect()}
    got = whole.collect()
    assert got and all(r.decoded_sha256 == texts[r.doc_id] and len(r.ids) == 4 * r.n_tokens for r in got)
    assert bag(whole.drop("ids")) == bag(corpus_pipeline.run(spark, sf_dir).drop("ids"))


def test_stages_take_awkward_and_empty_tables(spark, sf_dir, awkward, empty):
    for docs in (awkward, empty):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.count() <= 3 * docs.count()


def test_exact_dedup_reads_texts_in_small_batches(spark, sf_dir):
    """A session that says nothing of it; one with a size of its own keeps that."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    own = spark.newSession()
    rows = queries.op9_exact_dedup(own, sf_dir)
    assert int(own.conf.get(key)) <= 256
    assert rows.count() == table(own, sf_dir, "documents").count()
    other = spark.newSession()
    other.conf.set(key, "1024")
    queries.op9_exact_dedup(other, sf_dir)
    assert other.conf.get(key) == "1024"
