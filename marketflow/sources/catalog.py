"""Bucketed copies of the stored tables in Spark's catalog, for joins to the dimension without a shuffle.

Both fact tables and the dimension are dealt by a hash of `condition_id` into the same number of buckets when they are
written. An aggregation per market then runs inside a bucket, and so does its join to the dimension; only the result of
the query moves. A market with a third of all rows stays in one bucket, so the buckets suit queries that aggregate per
market first (combining in every task); row-level joins with such a market go through `operators.joins.attach`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.sources.tables import SORT_KEYS

KEY = "condition_id"
BUCKET_BYTES = 256 * 1024 * 1024


def bucket_count(size: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """A power of two for a table of `size` bytes, so that tables of other sizes can share the dealing."""
    return 1 << max(0, -(-size // bucket_bytes) - 1).bit_length()


def save_bucketed(df: DataFrame, name: str, table: str, buckets: int) -> None:
    """Write the rows of a stored table as the catalog table `name`, replacing it.

    Rows are dealt by the same hash before the write, so each bucket is one file written by one task. Rows without a
    condition share a bucket.
    """
    keys = [c for c in SORT_KEYS[table] if c in df.columns]
    dealt = df.repartition(buckets, F.col(KEY))
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, KEY).sortBy(*keys).saveAsTable(name)


def bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
