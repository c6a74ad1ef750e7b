"""Corpus pipeline: language, exact and near duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a frame that is written as Parquet and read again for the next one.
All stages but the last return the columns of ``documents``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lanestride.llm import decontaminate, language, near_copies, packing, radix_dedup
from lanestride.session import stage

WORKER_UNITS = 200_000  # units that a Python worker keeps while packing; it lives on into the next run's stages
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those that the language filter rejects go."""
    return language.keep_known_languages(docs).select(*COLUMNS)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts."""
    return radix_dedup.drop_exact_duplicates(docs).select(*COLUMNS)


def distinct_contents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (5-word shingles, similarity 0.8 or more).

    Fingerprints are compared as in operator 5; bands add the pairs beyond its radius, and an exact check follows.
    """
    return near_copies.drop_near_copies(docs).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, each with its sequence and its offset there."""
    return packing.pack(docs, cache_units=WORKER_UNITS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identified),
    ("exact_dedup", distinct_texts),
    ("near_dedup", distinct_contents),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL cannot express the language filter and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result staged in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs)
    return docs
