"""The operators' queries over the given tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marketlens.session import scratch_path

from . import decontaminate, embedding_dedup, html_text, jaccard_join, language_id, license_scan, packing, periodic_runs, phrase_mining, quality_rules, suffix_dedup, token_store, url_filter
from .common import table

#: Place of a public tokenizer's file; a parameter of the operators.
VOCABULARY = public_tokenizers.path


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.report(table(spark, sf_dir, "documents"))


def license_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY("word_bpe_49k.json"), end_id=1)


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_store.write(table(spark, sf_dir, "documents"), path, VOCABULARY("byte_bpe_50k.json"), end_id=0)
    return token_store.digests(spark, path)


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(table(spark, sf_dir, "documents"))


def vector_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.report(table(spark, sf_dir, "embeddings"))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": ngram_jaccard,
    "op2_license_scan": license_spans,
    "op3_url_filter": url_rules,
    "op4_packing": vector_packing,
    "op5_token_files": token_files,
    "op6_language_id": languages,
    "op7_suffix_dedup": suffix_repeats,
    "op8_decontamination": benchmark_leaks,
    "op9_html_text": page_text,
    "op10_quality_rules": quality_ledger,
    "op11_periodic_runs": word_runs,
    "op12_embedding_dedup": vector_copies,
    "op13_phrase_mining": phrases,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op2_license_scan": license_scan.oracle_sql(),
    "op3_url_filter": url_filter.oracle_sql(),
    "op10_quality_rules": quality_rules.oracle_sql(),
    "op12_embedding_dedup": embedding_dedup.oracle_sql(),
    "op13_phrase_mining": phrase_mining.oracle_sql(),
}
