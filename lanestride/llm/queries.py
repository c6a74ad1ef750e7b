"""The registered queries of this subpackage and their check SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lanestride.llm import (
    collocations,
    decontaminate,
    language,
    packing,
    pii,
    prefix_trie,
    quality,
    radix_dedup,
    simhash,
    substring_dedup,
    token_rollup,
    url_filter,
    window_dedup,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rollup.corpus_totals(table(spark, sf_dir, "documents"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op3_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_languages(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.remove_repeated_windows(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_rollup": op1_token_rollup,
    "op2_personal_data": op2_personal_data,
    "op3_radix_dedup": op3_radix_dedup,
    "op4_url_rules": op4_url_rules,
    "op5_simhash": op5_simhash,
    "op6_packing": op6_packing,
    "op7_repeated_strings": op7_repeated_strings,
    "op8_decontaminate": op8_decontaminate,
    "op9_language": op9_language,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_repeated_windows": op12_repeated_windows,
    "op13_conversation_trie": op13_conversation_trie,
}
CHECK_SQL: dict[str, str] = {
    "op3_radix_dedup": radix_dedup.EXACT_SQL,
    "op4_url_rules": url_filter.URL_SQL,
    "op11_collocations": collocations.COLLOCATION_SQL,
    "op12_repeated_windows": window_dedup.WINDOW_SQL,
    "op13_conversation_trie": prefix_trie.TRIE_SQL,
}
