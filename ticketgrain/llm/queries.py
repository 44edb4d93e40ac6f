"""Queries of the operators over the driver tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ticketgrain.llm import (
    byte_bpe, fingerprints, html_extraction, importance_resampling, lexical_search, license_scan, line_dedup, lm_scoring, packing, quality_rules, secret_scan, simhash, token_counts,
)
from ticketgrain.llm.common import documents
from ticketgrain.llm.oracles import ORACLES as ORACLES
from ticketgrain.plans.registry import rounded, table
from ticketgrain.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(documents(spark, sf_dir))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(documents(spark, sf_dir), BYTE_RANKS, PATTERN)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of this query's own, so that it counts everything it returns
    return token_counts.count_tokens(documents(spark, sf_dir), WORD_BPE, scratch_path(spark, "token-cache"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(documents(spark, sf_dir))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(documents(spark, sf_dir), MULTI_RANKS, PATTERN)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality_rules.quality(documents(spark, sf_dir)))


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), WORD_BPE)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_text(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in (
        op1_fingerprints, op2_secret_scans, op3_token_counts, op4_lm_scores, op5_byte_bpe, op6_quality_rules,
        op7_license_scans, op8_packing, op9_simhash, op10_line_dedup, op11_lexical_search,
        op12_importance_resampling, op13_html_extraction,
    )
}
