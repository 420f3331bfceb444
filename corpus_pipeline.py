"""From raw documents to encoded training documents, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daytally.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from daytally.llm.common import table, written
from daytally.llm.queries import bpe_digests
from daytally.llm.training import in_fold

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores below one half.

    Rows without text score as ones without words and stay; texts of any length are scored
    whole; equal rows stay or go together; nulls and extra columns pass; an empty table gives
    an empty result."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), in_fold(5, 0))
    return toxicity.clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id; a null id is below all others, and of
    ties one row stays. Null and empty texts are equal; texts of any length count whole; extra
    columns pass; an empty table gives an empty result."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar shingle sets (five words, 80 %) the one
    with the smallest id.

    Documents without words and rows with a null id stay; repeated rows of one id stay or go
    together; texts of any length count whole; extra columns pass; an empty table gives an
    empty result."""
    return ngram_join.one_of_each(docs, ngram_join.Similarity(words=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate and its draw say. A null source is one
    source, null ids share a draw, empty texts have no words; texts stay whole; extra columns
    pass; an empty table gives an empty result."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of each document's whole text, of any
    length. A null text is empty; null ids and repeated rows pass, other columns do not; an
    empty table gives an empty result."""
    return bpe_digests(bpe.there_and_back(docs, bpe.vocabulary()), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Model scores and token ids have no SQL: the tests hold the stages against brute-force
#: versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each written and read again, from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
