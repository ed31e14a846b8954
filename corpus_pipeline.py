"""Corpus preparation in five stages, each one operator of ``tripweave.llm`` applied to all its predecessor kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is written as Parquet and read again as
the next stage's documents. All stages but the last return the columns of ``docs``. Null texts, empty tables and
repeated rows are handled as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripweave.llm import decontaminate, jaccard, language, mixture, toxicity
from tripweave.llm.common import ready, stored, table

#: SQL cannot express the trained stages; tests/llm/test_pipeline.py holds the result against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or model scores below one half."""
    ready(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the context trees recognise."""
    ready(spark)
    return language.keep_known(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked at similarity 0.75 or more."""
    ready(spark)
    return jaccard.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a near copy of a benchmark item."""
    ready(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the scheduled mix takes of each document that is left."""
    ready(spark)
    return mixture.taken(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_languages),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixture", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
