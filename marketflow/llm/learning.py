"""Bounded training samples for the classifiers that are trained on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def sample_of(rows: DataFrame, size: int, target: str) -> DataFrame:
    """(doc_id, text, target) of at most `size` documents: those whose doc_id hashes lowest.

    Only ids pass through the driver. Of rows that repeat a doc_id the smallest (target, text) counts.
    """
    key = F.xxhash64(F.col("doc_id").cast("string"))
    ids = rows.select("doc_id", key.alias("k")).distinct().orderBy("k", "doc_id").limit(size)
    top = ids.agg(F.max("k")).first()[0]
    picked = rows.where(key <= F.lit(top)) if top is not None else rows.where(F.lit(False))
    return picked.groupBy("doc_id").agg(F.min(F.struct(target, "text")).alias("s")).select("doc_id", "s.text", f"s.{target}")
