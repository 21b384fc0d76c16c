"""Book tables: the 1-second best bid/offer series, and top-of-book levels from unranked orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marketflow.functions.metrics import mid, spread
from marketflow.operators.running import positions


def bbo_1s(levels: DataFrame) -> DataFrame:
    """Last level-1 row of every token and second."""
    state = F.struct("exchange_ts", "local_ts", "bid_px", "bid_sz", "ask_px", "ask_sz")
    last = (
        levels.filter(F.col("level") == 1)
        .groupBy(F.date_trunc("second", "exchange_ts").alias("ts_bucket"), "market_id", "condition_id", "token_id")
        .agg(F.max(state).alias("_s"))
    )
    return last.select(
        "ts_bucket",
        "market_id",
        "condition_id",
        "token_id",
        *[F.col(f"_s.{c}").alias(c) for c in ("bid_px", "bid_sz", "ask_px", "ask_sz")],
    ).withColumns({"spread": spread(F.col("bid_px"), F.col("ask_px")), "mid_px": mid(F.col("bid_px"), F.col("ask_px"))})


def _best_first(orders: DataFrame) -> DataFrame:
    """Bids by falling price, asks by rising price, as one rising sort key."""
    return orders.withColumn("_k", F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price")))


def rank_book(orders: DataFrame, snapshot: list[str], ties: list[str]) -> DataFrame:
    """Rank every order of every (snapshot, side), best price first, as `book_rank`."""
    return positions(_best_first(orders), [*snapshot, "side"], ["_k", *ties], "book_rank").drop("_k")


def book_levels(orders: DataFrame, snapshot: list[str], ties: list[str], depth: int = 10) -> DataFrame:
    """Pair bid i with ask i for the best `depth` orders; a side that is shorter gives nulls.

    The rank filter is applied before the shuffle as well as after it (Spark's group limit), so at most
    `depth` rows per map task and side leave for a snapshot of any size.
    """
    best = W.partitionBy(*snapshot, "side").orderBy("_k", *ties)
    ranked = _best_first(orders).withColumn("level", F.row_number().over(best)).filter(F.col("level") <= depth)

    def value_of(side: str, col: str):
        return F.max(F.when(F.col("side") == side, F.col(col)))

    return ranked.groupBy(*snapshot, "level").agg(
        value_of("bid", "price").alias("bid_px"),
        value_of("bid", "size").alias("bid_sz"),
        value_of("ask", "price").alias("ask_px"),
        value_of("ask", "size").alias("ask_sz"),
    )


def both_sides(levels: DataFrame, bid: str, ask: str) -> DataFrame:
    """One row per side and level with a value: condition_id, token_id, exchange_ts, level, side, value."""
    sides = F.stack(F.lit(2), F.lit("bid"), F.col(bid), F.lit("ask"), F.col(ask)).alias("side", "value")
    return levels.select("condition_id", "token_id", "exchange_ts", "level", sides).filter(F.col("value").isNotNull())
