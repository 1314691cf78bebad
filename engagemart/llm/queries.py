"""One query per training-data operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from engagemart.llm import (
    alignment,
    bwt_dedup,
    decision_list,
    exact_dedup,
    lexical,
    license_scan,
    mixing,
    packing,
    partenum,
    sharding,
    suffix_trees,
    token_store,
    warc,
)
from engagemart.llm.common import table

TOKENIZER = "word_bpe_49k.json"
TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents")).drop("blocks")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decision_list.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.dedup_digest(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.near_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_trees.dedup_digest(table(spark, sf_dir, "documents"))


def op11_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.roundtrip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in (TOKENIZER_A, TOKENIZER_B)]
    return alignment.alignment(table(spark, sf_dir, "documents"), *paths)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_license_scan,
        op3_quality_rules,
        op4_suffix_array_dedup,
        op5_best_fit_packing,
        op6_exact_dedup,
        op7_ngram_jaccard_join,
        op8_mixing,
        op9_warc,
        op10_substring_dedup,
        op11_token_output,
        op12_lexical_search,
        op13_tokenizer_alignment,
    )
}
