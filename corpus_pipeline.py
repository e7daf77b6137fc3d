"""From documents to tokens: language, quality, near-duplicates, benchmark overlap, byte-level BPE.

Each stage takes what the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import pagesieve
from pagesieve.llm import bpe, decontaminate, language, near_dup, quality
from pagesieve.llm.queries import PATTERN, RANKS
from pagesieve.session import stored
from pagesieve.sources.tables import read_table

# Python functions travel to the executors whole, which need not have this folder on their path.
cloudpickle.register_pickle_by_value(pagesieve)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; it is learned from those that name theirs."""
    return language.keep_identified(docs, language.learn_dictionaries(docs))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted good; quality is learned from those with labels."""
    return quality.keep_good(docs, quality.learn_model(docs, read_table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 of 100 five-word shingles."""
    return near_dup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words of a benchmark item in a row."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, as little-endian unsigned 32-bit integers, in place of the text."""
    return bpe.encode_texts(docs, RANKS, PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_level_bpe", byte_level_bpe),
]

#: SQL has no compression, network or tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
