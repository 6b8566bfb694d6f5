"""Registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyscope.llm import bytepairs, chat, language, manifest, mixing, packing, quality, sharding, simhash, sqltext, structure, suffixes, toxicity, vectors

BYTE_VOCABULARY, WORD_VOCABULARY = "byte_bpe_50k.json", "word_bpe_49k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_links(_table(spark, sf_dir, "embeddings"))


def op2_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bytepairs.encode_decode(_table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY), with_values=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op3_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op4_binary_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY)).drop("ids")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents")).drop("row")


def op7_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", *[f"p_{c}" for c in toxicity.CATEGORIES], "flagged")


def op8_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(_table(spark, sf_dir, "conversations"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.without_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", *[F.col(f"cut.{c}").alias(c) for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.repair_structure(_table(spark, sf_dir, "conversations"))


def op12_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("plays")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_vectors, op2_byte_pairs, op3_slot_shards, op4_binary_pieces, op5_simhash, op6_line_quality,
        op7_toxicity_chain, op8_role_repair, op9_language, op10_suffix_dedup,
        op11_structure_repair, op12_curriculum_mix, op13_merkle_manifest,
    )
}
ORACLES: dict[str, str] = {
    "op1_near_vectors": sqltext.OP1, "op6_line_quality": sqltext.OP6, "op10_suffix_dedup": sqltext.OP10,
    "op11_structure_repair": sqltext.OP11, "op12_curriculum_mix": sqltext.OP12, "op13_merkle_manifest": sqltext.OP13,
}
