"""The corpus pipeline: documents through five operators of gridloom.llm, stage by stage.

Each stage takes the documents its predecessor kept and returns them in the columns of documents;
the last adds how often each goes into the mix. Sampling, classifiers and joins without a SQL form are tested against
brute force in ``tests/llm``, so there is no ``ORACLE_SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.common import documents, shared_table, table
from gridloom.llm.decontaminate import without_passages
from gridloom.llm.language_id import known_languages
from gridloom.llm.mixing import mixed_documents
from gridloom.llm.ngram_join import one_of_each_group
from gridloom.llm.personal_data import without_personal_data

ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; lang is kept as it is given."""
    return known_languages(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_passages(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked."""
    return without_personal_data(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents that are taken, texts included, with their copies and words."""
    return mixed_documents(docs)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in their order; each reads what the one before it wrote."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return docs
