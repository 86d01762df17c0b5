"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orefold.llm import (
    bpe, fingerprint, language, lines, minhash, oracles, packing, quality, repair, repeats, rules, toxicity, trie, warc,
)
from orefold.llm.common import table

import public_tokenizers


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_digests(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(rules.measure(table(spark, sf_dir, "documents")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.token_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.removal_digests(table(spark, sf_dir, "documents"))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_toxicity, op2_minhash_dedup, op3_substring_dedup, op4_best_fit_packing, op5_fingerprints, op6_quality,
        op7_language, op8_warc, op9_quality_rules, op10_byte_bpe, op11_line_dedup,
        op12_structure_repair, op13_prefix_trie,
    )
}

ORACLES = {
    "op8_warc": oracles.OP8,
    "op9_quality_rules": oracles.OP9,
    "op11_line_dedup": oracles.OP11,
    "op13_prefix_trie": oracles.OP13,
}
