"""Live aggregates over the trade and level streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions.aggregates import total_if
from marketflow.functions.metrics import mid, notional, probability

WATERMARK = "2 minutes"


def _windowed(df: DataFrame, every: str, watermark: str, *keys: str):
    return df.withWatermark("exchange_ts", watermark).groupBy(F.window("exchange_ts", every), *keys)


def stream_counts(df: DataFrame, every: str = "1 minute", watermark: str = WATERMARK) -> DataFrame:
    """Rows per minute; for book updates give the level-1 rows. Use update or append mode."""
    counts = _windowed(df, every, watermark).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(F.col("window.start").alias("time"), "rows")


def stream_volume(trades: DataFrame, every: str = "5 seconds", watermark: str = WATERMARK) -> DataFrame:
    """Bought and sold notional per token and time bucket. Use update or append mode."""
    value = notional(F.col("price"), F.col("size"))
    volume = _windowed(trades, every, watermark, "condition_id", "token_id").agg(
        total_if(value, F.col("side") == "BUY").alias("buy_volume"),
        total_if(value, F.col("side") == "SELL").alias("sell_volume"),
    )
    return volume.select("condition_id", "token_id", F.col("window.start").alias("time"), "buy_volume", "sell_volume")


def stream_quotes(levels: DataFrame) -> DataFrame:
    """Newest two-sided quote and its probabilities, one state row per token. Use update mode."""
    quoted = levels.filter((F.col("level") == 1) & F.col("bid_px").isNotNull() & F.col("ask_px").isNotNull())
    state = F.struct("exchange_ts", "local_ts", "bid_px", "ask_px")
    last = quoted.groupBy("condition_id", "token_id").agg(F.max(state).alias("q"))
    mid_px = mid(F.col("q.bid_px"), F.col("q.ask_px"))
    return last.select(
        "condition_id",
        "token_id",
        F.col("q.exchange_ts").alias("exchange_ts"),
        F.col("q.bid_px").alias("bid_px"),
        F.col("q.ask_px").alias("ask_px"),
        probability(mid_px).alias("yes_pct"),
        probability(mid_px, yes=False).alias("no_pct"),
    )
