"""Corpus pipeline: language ID, line dedup, near-duplicates, decontamination, mixing.

Every stage takes (spark, docs, sf_dir), works on all that the one before kept and returns the columns of documents;
the last adds `taken`, the words that the mix takes of each document. Between stages the documents are written as
Parquet to the shared folder, so a lost executor costs no earlier stage. Nulls, empty tables and extra columns are
treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketflow.llm import decontaminate, language, lines, minhash, mixing
from marketflow.llm.common import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language ID rejects go."""
    return language.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines like an earlier line go, and documents of which nothing is left."""
    return lines.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with `taken`."""
    return mixing.mixture(docs)


STAGES = [
    ("language", known_language),
    ("lines", line_dedup),
    ("near_duplicates", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
]
ORACLE_SQL = None  # a learned model and similarity joins are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
