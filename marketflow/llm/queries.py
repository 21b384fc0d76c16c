"""Registered queries of the text operators: each reads its whole table at production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketflow.llm import (
    collocations,
    decontaminate,
    fingerprint,
    language,
    licenses,
    lines,
    minhash,
    mixing,
    packing,
    quotes,
    spelling,
    substrings,
    toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_edits(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(table(spark, sf_dir, "documents"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(table(spark, sf_dir, "documents"))


def op4_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.scan(docs, benchmark, keep=["doc_id"]))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"))


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("row_key")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_licenses, op3_substrings, op4_conversations, op5_decontamination,
        op6_near_duplicates, op7_language, op8_mixture, op9_toxicity, op10_lines,
        op11_packing, op12_spelling, op13_collocations,
    )
}
SQL: dict[str, str] = {"op8_mixture": mixing.SQL}
