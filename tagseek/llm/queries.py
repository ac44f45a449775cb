"""Registered queries of this subpackage, and what SQL can say of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, embedding_dedup, html_text, langid, merkle, near_dedup, packing, pii, quality, sharding, suffix_dedup, token_alignment, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op5_suffix_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.deduplicate(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(_table(spark, sf_dir, "documents"))


def op10_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.groups(_table(spark, sf_dir, "embeddings"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(_table(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality, op2_language, op3_decontamination, op4_page_text, op5_suffix_duplicates, op6_packing, op7_personal_data,
        op8_toxicity, op9_near_duplicates, op10_embedding_duplicates, op11_token_alignment, op12_merkle_manifest, op13_sharding,
    )
}
ORACLES: dict[str, str] = {"op12_merkle_manifest": merkle.ORACLE}
