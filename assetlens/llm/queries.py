"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlens.llm import (decontamination, exact_dedup, language_id, lexical_search, packing, prefix_trie, quality,
                           secret_scan, simhash_dedup, substring_dedup, suffix_dedup, token_files, url_filter)
from assetlens.llm.common import read_table

WORD_BPE, WORD_BPE_SIZE = str(public_tokenizers.path("word_bpe_49k.json")), 49_408
BYTE_BPE = str(public_tokenizers.path("byte_bpe_50k.json"))
"""Public vocabulary files; every node has them at the same path."""


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removed_spans(read_table(spark, sf_dir, "documents")).drop("text_key", "cut")


def op2_simhash_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.with_hex(simhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents")))


def op3_rule_ensemble_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_suffix_run_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.with_digest(suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")))


def op5_temporal_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_filter.evaluate(url_filter.captures_of(pages), url_filter.entries_of(pages))


def op6_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_digest(packing.pack_documents(read_table(spark, sf_dir, "documents"), BYTE_BPE))


def op7_tiling_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminations(read_table(spark, sf_dir, "documents"),
                                           read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", F.size("tiles").cast("long").alias("n_tiles"),
                        F.array_max(F.transform("tiles", lambda t: t["words"])).alias("longest_tile"))


def op8_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op9_bit_packed_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = token_files.write_token_files(read_table(spark, sf_dir, "documents"), WORD_BPE, WORD_BPE_SIZE)
    return token_files.with_digest(token_files.read_token_files(shards))


def op10_digest_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_opening_trie(read_table(spark, sf_dir, "conversations"))


def op12_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.with_digest(secret_scan.scan_documents(read_table(spark, sf_dir, "documents")))


def op13_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_simhash_anchor_dedup, op3_rule_ensemble_quality, op4_suffix_run_dedup,
    op5_temporal_url_filter,
    op6_cost_balanced_packing, op7_tiling_decontamination, op8_cross_parsing_language,
    op9_bit_packed_token_files, op10_digest_index_dedup,
    op11_prefix_trie, op12_secret_automaton, op13_ball_tree_search)}
