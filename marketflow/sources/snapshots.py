"""Newest market versions and the token map, kept up to date from new version batches only.

`<root>/markets_snapshot/generation=<n>/` holds `markets` (the newest version of every market), `tokens` (the newest
market that lists each token), `grams` (the search index of the questions) and `files` (the files of the versions table that are merged in). A refresh reads the last
generation and the files that came since: rows whose key the new files touch are compared with them, all others pass
without a shuffle while the touched keys are few. `files` is written last, so a generation without it does not count. If
a merged file is gone (its batch was repeated, or the table compacted), the generation is made anew from all versions,
because the rows it gave cannot be taken back. Two generations stay, the last for its readers and the one before for
those that began earlier. One process refreshes at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.operators.dimension import latest, latest_markets, latest_tokens, listed_tokens
from marketflow.operators.search import find, postings
from marketflow.schemas import TABLES
from marketflow.sources import folders
from marketflow.sources.tables import load

FOLDER = "markets_snapshot"
MARKET = ["condition_id", "market_id"]
KEPT = 2  # generations


def merged_latest(current: DataFrame, fresh: DataFrame, keys: list[str], order: str = "updated_at") -> DataFrame:
    """The newest row per key of both; `current` has one row per key and only the touched ones are looked at.

    Equal to `latest` over all rows that ever came, because the newest of the newest is the newest.
    """
    columns = [c for c in current.columns if c not in keys]
    newest = latest(fresh.select(*current.columns), keys, columns, order)
    touched = newest.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    contested = current.join(touched, same, "left_semi").unionByName(newest)
    return current.join(touched, same, "left_anti").unionByName(latest(contested, keys, columns, order).select(*current.columns))


def _generations(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete generations."""
    found = (int(g.removeprefix("generation=")) for g in folders.children(spark, f"{root}/{FOLDER}"))
    return sorted(g for g in found if folders.exists(spark, f"{root}/{FOLDER}/generation={g}/files/_SUCCESS"))


def _read(spark: SparkSession, root: str, number: int, part: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{FOLDER}/generation={number}/{part}")


def _versions(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return load(spark, root, "markets_dim")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def refresh(spark: SparkSession, root: str) -> int | None:
    """Bring the snapshot up to date; the number of its generation, None before the first version."""
    versions = _versions(spark, root)
    if versions is None:
        return None
    files, done = set(versions.inputFiles()), _generations(spark, root)
    old = {r.file for r in _read(spark, root, done[-1], "files").collect()} if done else set()
    if done and files == old:
        return done[-1]
    columns = TABLES["markets_dim"].names
    if done and old <= files:
        last, new = done[-1], sorted(files - old)
        fresh = spark.read.schema(TABLES["markets_dim"]).parquet(*new)
        markets = merged_latest(_read(spark, root, last, "markets"), fresh, MARKET)
        tokens = merged_latest(_read(spark, root, last, "tokens"), listed_tokens(fresh), ["token_id"])
    else:
        markets, tokens = latest_markets(versions.select(*columns)).select(*columns), latest_tokens(listed_tokens(versions))
    number = (done[-1] if done else -1) + 1
    base = f"{root}/{FOLDER}/generation={number}"
    markets.sortWithinPartitions("condition_id").write.mode("overwrite").parquet(f"{base}/markets")
    grams = postings(spark.read.parquet(f"{base}/markets"), MARKET, "question")
    grams.repartitionByRange("gram", *MARKET).sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{base}/grams")
    tokens.sortWithinPartitions("token_id").write.mode("overwrite").parquet(f"{base}/tokens")
    spark.createDataFrame([(f,) for f in sorted(files)], "file string").coalesce(1).write.mode("overwrite").parquet(f"{base}/files")
    for g in folders.children(spark, f"{root}/{FOLDER}"):
        if int(g.removeprefix("generation=")) <= number - KEPT:
            folders.remove(spark, f"{root}/{FOLDER}/{g}")
    return number


def newest_markets(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest version of every market, from a snapshot that is brought up to date first."""
    number = refresh(spark, root)
    return None if number is None else _read(spark, root, number, "markets")


def search(spark: SparkSession, root: str, text: str) -> DataFrame | None:
    """Newest versions of the markets whose question contains `text`, by the search index."""
    number = refresh(spark, root)
    if number is None:
        return None
    return find(_read(spark, root, number, "markets"), _read(spark, root, number, "grams"), MARKET, "question", text)


def newest_tokens(spark: SparkSession, root: str) -> DataFrame | None:
    """token_id, condition_id, market_id of the newest version that lists each token."""
    number = refresh(spark, root)
    return None if number is None else _read(spark, root, number, "tokens").select("token_id", "condition_id", "market_id")
