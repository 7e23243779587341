"""From raw documents to packed training sequences, one stage after the other.

Every stage's rows are written as a table in the shared folder and read again by the next, so a lost executor never costs more
than the stage it was lost in.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import decontaminate, jaccard_join, language_id, packing, suffix_dedup
from marketlens.llm.common import parked, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language_id.accepted(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five-word shingles, similarity 0.8."""
    return jaccard_join.deduplicate(docs, k=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 400 bytes and the passages of over 50 words that stand more than once."""
    return suffix_dedup.remove(docs, words=51)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("ngram_jaccard", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

#: Hash classes, learned models and tokenizers have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = parked(stage(spark, docs, sf_dir), name)
    return docs
