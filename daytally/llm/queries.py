"""The operators over whole tables, one query each, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.llm import bpe, exact_dedup, knn, merkle, mixing, ngram_join, packing, part_codes, passages, pii, quality, token_records, toxicity
from daytally.llm.common import keep_reads_small, table
from daytally.llm.training import in_fold


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.plan(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = token_records.write(docs, token_records.scratch(spark), token_records.vocabulary())
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return token_records.read(manifest).select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(bpe.there_and_back(table(spark, sf_dir, "documents"), bpe.vocabulary()))


def bpe_digests(decoded: DataFrame, *more: str) -> DataFrame:
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), in_fold(5, 0))
    return _predicted(toxicity.score(docs, model), in_fold(5, 0, "doc_id"), "n_passages")


def _predicted(scored: DataFrame, held_out: Column, *more: str) -> DataFrame:
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted, *more)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    n_of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = pii.as_text(F.filter("spans", lambda s: s["kind"] != pii.TERM))
    return found.select("doc_id", *map(n_of, pii.KINDS), F.sha2(base, 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep_reads_small(spark)
    marked = exact_dedup.mark(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = quality.fit(docs, table(spark, sf_dir, "labels"), in_fold(3, 1))
    return _predicted(quality.score(docs, weights), in_fold(3, 1, "doc_id"))


def op11_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = part_codes.compress(table(spark, sf_dir, "embeddings"))
    rows = part_codes.with_label_error(codes)
    return rows.select("vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.struct(*[(F.col(c) + 1 if c == "n_chars" else F.col(c)).alias(c) for c in merkle.COLUMNS])
    picked = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, tampered)
    rows = merkle.verified(merkle.manifest(docs, picked))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), packing.vocabulary())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "step")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_knn": op2_knn,
        "op3_token_records": op3_token_records,
        "op4_ngram_join": op4_ngram_join,
        "op5_bpe": op5_bpe,
        "op6_passages": op6_passages,
        "op7_toxicity": op7_toxicity,
        "op8_pii": op8_pii,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_quality": op10_quality,
        "op11_part_codes": op11_part_codes,
        "op12_merkle": op12_merkle,
        "op13_packing": op13_packing,
    }
