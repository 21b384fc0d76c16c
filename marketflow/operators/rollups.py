"""Partial aggregates per minute that add up: written once per batch, merged when they are read.

A batch writes one row per (market, token, minute) and one per (table, minute), however many trades or levels it holds.
Sums, counts, minima and maxima of partial rows give those of all rows, and HyperLogLog sketches unite to the sketch of
all rows, so a dashboard that refreshes every few seconds reads minutes in place of trades. A row that comes late adds a
partial row for its own minute; a repeated batch replaces its partial rows with themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions.metrics import bucket, hour_of, minute_of, notional

TOKEN = ["condition_id", "token_id"]
LG_K = 14  # sketches of 2^14 registers: a standard error of 0.8 % after a union
SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def trade_minutes(trades: DataFrame, *by: str) -> DataFrame:
    """Partial row per market, token and minute, and per value of the columns `by` (many batches at once)."""
    value, side = notional(F.col("price"), F.col("size")), F.col("side")
    return trades.groupBy(*TOKEN, *by, minute_of("exchange_ts").alias("minute")).agg(
        F.count(F.lit(1)).alias("trades"),
        F.sum(value).alias("volume"),
        F.sum(F.when(side == "BUY", value)).alias("buy_volume"),
        F.sum(F.when(side == "SELL", value)).alias("sell_volume"),
        F.sum("size").alias("total_size"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.min("exchange_ts").alias("first_trade"),
        F.max("exchange_ts").alias("last_trade"),
    )


def minute_sketches(rows: DataFrame, table: str) -> DataFrame:
    """Partial row per minute: rows, and sketches of the distinct tokens and markets of one table."""
    return rows.groupBy(minute_of("exchange_ts").alias("minute")).agg(
        F.lit(table).alias("seen_in"),
        F.count(F.lit(1)).alias("rows"),
        F.hll_sketch_agg("token_id", LG_K).alias("tokens"),
        F.hll_sketch_agg("condition_id", LG_K).alias("markets"),
    )


def _whole_minutes(every: str) -> str:
    number, unit = every.split()
    seconds = float(number) * SECONDS[unit.rstrip("s")]
    if seconds % 60:
        raise ValueError(f"{every} is not a number of whole minutes")
    return every


def _sum_or_zero(name: str) -> Column:
    return F.coalesce(F.sum(name).cast("double"), F.lit(0.0)).alias(name)


def bucket_volume(minutes: DataFrame, every: str = "5 minutes", by_token: bool = True) -> DataFrame:
    """Bought and sold notional per time bucket of whole minutes, as `plans.trades.bucket_volume` gives it."""
    keys = TOKEN if by_token else TOKEN[:1]
    out = minutes.groupBy(*keys, bucket("minute", _whole_minutes(every)).alias("time"))
    return out.agg(_sum_or_zero("buy_volume"), _sum_or_zero("sell_volume")).orderBy(*keys, "time")


def bucket_total(minutes: DataFrame, every: str = "60 seconds") -> DataFrame:
    out = minutes.groupBy(*TOKEN, bucket("minute", _whole_minutes(every)).alias("time"))
    return out.agg(F.sum("volume").cast("double").alias("volume")).orderBy(*TOKEN, "time")


def trades_per_minute(minutes: DataFrame) -> DataFrame:
    return minutes.groupBy(F.col("minute").alias("time")).agg(F.sum("trades").alias("trades")).orderBy("time")


def hourly_volume(minutes: DataFrame) -> DataFrame:
    out = minutes.groupBy("condition_id", hour_of("minute").alias("hour"))
    return out.agg(F.sum("volume").cast("double").alias("volume")).orderBy("condition_id", "hour")


def market_totals(minutes: DataFrame) -> DataFrame:
    """Statistics per market that partial rows hold in full."""
    return minutes.groupBy("condition_id").agg(
        F.sum("trades").alias("total_trades"),
        F.sum("volume").cast("double").alias("total_volume"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        (F.sum("total_size").cast("double") / F.sum("trades")).alias("avg_trade_size"),
        _sum_or_zero("buy_volume"),
        _sum_or_zero("sell_volume"),
        F.min("first_trade").alias("first_trade"),
        F.max("last_trade").alias("last_trade"),
    )


def distinct_seen(sketches: DataFrame) -> DataFrame:
    """seen_in, rows, tokens, markets: rows and approximate distinct counts of each table, and of all (seen_in null).

    Filter the minutes of the look-back first; a look-back that begins within a minute takes that whole minute.
    """
    united = [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in ("tokens", "markets")]
    return sketches.rollup("seen_in").agg(F.sum("rows").alias("rows"), *united)
