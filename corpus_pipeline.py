"""Corpus preparation: quality rules, spread lines, near copies, mixture, packing.

Each stage takes the rows its predecessor kept, with all columns of ``documents``; the last returns the pieces of the
packed sequences with their token ids. Stages handle nulls, ties and repeated rows as their operators state; very long
texts go through whole; an empty table stays empty; further columns, whatever their names, are kept up to the last stage.
SQL cannot express compression, fingerprints and tokenizers, so tests compare with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm import line_dedup, mixing, packing, quality, simhash
from shelfwise.session import fresh_folder, store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return docs.where(quality.quality(F.col("text")).getField("kept"))


def without_spread_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sources go, but for their first occurrence; n_chars follows the text."""
    cleaned = line_dedup.remove_spread_lines(docs)
    return cleaned.select(
        *[
            F.col("text") if c == "text"
            else F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("doc.n_chars")).alias(c) if c == "n_chars"
            else F.col(f"doc.`{c}`")
            for c in docs.columns
        ]
    )


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    taken = mixing.mix(docs).where("mix.copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("mix.copies")))).select("doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids and places in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", good_documents),
    ("line dedup", without_spread_lines),
    ("simhash near-dedup", without_near_copies),
    ("mixing sources", mixed),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), fresh_folder(spark, name.replace(" ", "-")))
    return STAGES[-1][1](spark, docs, sf_dir)
