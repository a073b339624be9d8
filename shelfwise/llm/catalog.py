"""Registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm import (
    byte_bpe,
    chat,
    embedding_dedup,
    filter_audit,
    language_model,
    licenses,
    line_dedup,
    merkle,
    mixing,
    packing,
    quality,
    simhash,
    token_files,
)
from shelfwise.session import fresh_folder, store

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.remove_spread_lines(_documents(spark, folder)).select("doc.doc_id", "text", "n_lines", "n_removed")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(_documents(spark, folder), public_tokenizers.path(BYTE_BPE))
    return pieces.withColumn("ids_crc32", token_files.ids_crc32(F.col("ids"))).drop("ids")


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(_documents(spark, folder), licenses.known_licenses(spark))
    return found.select("doc.doc_id", "digest", "license_id", F.array_join("notices", ",").alias("notices"))


def op4_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = embedding_dedup.near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_documents(spark, folder)).select(
        "doc.doc_id",
        "mix.size",
        "mix.source_size",
        "mix.target",
        (F.col("mix.size") * F.col("mix.copies")).alias("taken"),
    )


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    probe = [(-1, 0, "user", control), (-1, 1, "assistant", control)]
    messages = chat.linear_tree(turns.unionByName(spark.createDataFrame(probe, turns.schema)))
    return chat.digests(chat.formatted(store(messages, fresh_folder(spark, "messages"))))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_copies(_documents(spark, folder)).select(
        "doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).select("doc_id", quality.quality(F.col("text")).alias("q")).select("doc_id", "q.*")


def op9_language_model(spark: SparkSession, folder: str) -> DataFrame:
    rows = language_model.scored_documents(_documents(spark, folder))
    perplexity = F.pow(F.lit(10.0), -F.col("lm.score") / F.col("lm.n_tokens"))
    return rows.select("doc.doc_id", "held_out", "train_tokens", "lm.*", perplexity.alias("perplexity"))


def op10_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = token_files.token_table(_documents(spark, folder), public_tokenizers.path(WORD_BPE))
    return rows.withColumn("ids_crc32", token_files.ids_crc32(F.col("ids"))).drop("ids")


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    text = merkle.lower_cased_third(F.col("doc_id"), F.col("text"))
    manifest = merkle.build(_documents(spark, folder), merkle.leaf_digest(text))
    root = F.lit(manifest.root).cast("binary")
    return merkle.prove(manifest).select(
        "doc_id",
        *[merkle.hex_text(c).alias(n) for n, c in (("leaf", F.col("leaf")), ("subroot", F.col("subroot")), ("root", root))],
        F.sha2(merkle.hex_text(F.col("proof")), 256).alias("proof_sha256"),
        merkle.hex_text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_RANKS)
    rows = byte_bpe.encode(_documents(spark, folder), path, public_tokenizers.PATTERN)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        byte_bpe.ids_sha256(F.col("ids")).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), path), 256).alias("decoded_sha256"),
    )


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return filter_audit.audit(filter_audit.failure_masks(_documents(spark, folder), labels))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_packing": op2_packing,
    "op3_licenses": op3_licenses,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_mixing": op5_mixing,
    "op6_chat": op6_chat,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_language_model": op9_language_model,
    "op10_token_ids": op10_token_ids,
    "op11_merkle": op11_merkle,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_filter_audit": op13_filter_audit,
}
