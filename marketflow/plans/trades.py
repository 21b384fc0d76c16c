"""Trade queries.

`span` is a closed (from, to) time range. With no market or token the keys lead the result columns. Series of one market
are in order; those of all markets are ordered only if `ordered` asks for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions.aggregates import mean, rounded, total, total_if
from marketflow.functions.metrics import bucket, hour_of, minute_of, notional, signed_notional
from marketflow.operators.distribution import heatmap, histogram
from marketflow.operators.filters import (
    at_level,
    in_series_order,
    lookback,
    non_empty,
    optional_eq,
    scoped,
    top,
    with_book,
)
from marketflow.operators.running import cumulative, running_rows

TOKEN = ["condition_id", "token_id"]


def _value() -> Column:
    return notional(F.col("price"), F.col("size"))


def _signed() -> Column:
    return signed_notional(F.col("side"), F.col("price"), F.col("size"))


def _buy() -> Column:
    return F.col("side") == "BUY"


def _sell() -> Column:
    return F.col("side") == "SELL"


def _keys(by_token: bool) -> list[str]:
    return TOKEN if by_token else ["condition_id"]


def trades_df(trades: DataFrame, as_of=None, market: str | None = None, hours: int = 24, ordered: bool | None = None) -> DataFrame:
    """Trades of the last hours with their notional, in time order."""
    rows = lookback(optional_eq(trades, "condition_id", market), as_of, f"{hours} HOURS", inclusive=False)
    out = rows.select("exchange_ts", "market_id", *TOKEN, "price", "size", _value().alias("notional"), "side", "trade_id")
    return in_series_order(out, market, ordered, "exchange_ts", "trade_id")


def market_profile(trades: DataFrame, as_of=None, market: str | None = None, hours: int = 24) -> DataFrame:
    """Eleven statistics per market."""
    rows = lookback(optional_eq(trades, "condition_id", market), as_of, f"{hours} HOURS", inclusive=False)
    return rows.groupBy("condition_id").agg(
        F.count(F.lit(1)).alias("total_trades"),
        total(_value()).alias("total_volume"),
        mean(F.col("price")).alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.stddev_samp("price").alias("price_std"),
        mean(F.col("size")).alias("avg_trade_size"),
        total_if(_value(), _buy()).alias("buy_volume"),
        total_if(_value(), _sell()).alias("sell_volume"),
        F.min("exchange_ts").alias("first_trade"),
        F.max("exchange_ts").alias("last_trade"),
    )


def hourly_volume(trades: DataFrame, as_of=None, market: str | None = None, hours: int = 24) -> DataFrame:
    rows = lookback(optional_eq(trades, "condition_id", market), as_of, f"{hours} HOURS", inclusive=False)
    out = rows.groupBy("condition_id", hour_of("exchange_ts").alias("hour")).agg(total(_value()).alias("volume"))
    return out.orderBy("condition_id", "hour")


def bucket_volume(
    trades: DataFrame,
    every: str = "5 seconds",
    by_token: bool = True,
    market: str | None = None,
    token: str | None = None,
    span: tuple | None = None,
) -> DataFrame:
    """Bought and sold notional per time bucket."""
    keys = _keys(by_token)
    out = (
        scoped(trades, market, token, span)
        .groupBy(*keys, bucket("exchange_ts", every).alias("time"))
        .agg(total_if(_value(), _buy()).alias("buy_volume"), total_if(_value(), _sell()).alias("sell_volume"))
    )
    return out.orderBy(*keys, "time")


def bucket_total(
    trades: DataFrame,
    every: str = "60 seconds",
    market: str | None = None,
    token: str | None = None,
    span: tuple | None = None,
) -> DataFrame:
    out = (
        scoped(trades, market, token, span)
        .groupBy(*TOKEN, bucket("exchange_ts", every).alias("time"))
        .agg(total(_value()).alias("volume"))
    )
    return out.orderBy(*TOKEN, "time")


def cumulative_volume(
    trades: DataFrame,
    by_token: bool = True,
    market: str | None = None,
    token: str | None = None,
    span: tuple | None = None,
    ordered: bool | None = None,
) -> DataFrame:
    """Running notional, one row per trade; trades of equal time share one value."""
    keys = _keys(by_token)
    out = cumulative(scoped(trades, market, token, span), {"cum_volume": _value()}, keys)
    return in_series_order(out, market, ordered, *keys, "exchange_ts")


def cumulative_delta(
    trades: DataFrame,
    with_volume: bool = False,
    market: str | None = None,
    token: str | None = None,
    span: tuple | None = None,
    ordered: bool | None = None,
) -> DataFrame:
    """Running signed notional, with the running notional from the same pass if wanted."""
    values = {"cum_volume": _value()} if with_volume else {}
    out = cumulative(scoped(trades, market, token, span), {**values, "cum_delta": _signed()}, TOKEN)
    return in_series_order(out, market, ordered, *TOKEN, "exchange_ts")


def cumulative_rows(trades: DataFrame, market: str | None = None, span: tuple | None = None, ordered: bool | None = None) -> DataFrame:
    """Running notional one trade at a time, per market, in (exchange_ts, trade_id) order."""
    rows = scoped(trades, market, None, span).select("condition_id", "exchange_ts", "trade_id", _value().alias("notional"))
    out = running_rows(rows, {"cum_volume": F.col("notional")}, ["condition_id"], ["exchange_ts", "trade_id"])
    return in_series_order(out, market, ordered, "condition_id", "exchange_ts", "trade_id")


def top_takers(
    trades: DataFrame,
    limit: int = 20,
    market: str | None = None,
    token: str | None = None,
    span: tuple | None = None,
) -> DataFrame:
    """Takers by traded volume."""
    stats = (
        non_empty(scoped(trades, market, token, span), "taker_address")
        .groupBy("taker_address")
        .agg(
            F.count(F.lit(1)).alias("trade_count"),
            F.sum(_value()).alias("_volume"),
            rounded(F.sum(_value()), 2).alias("total_volume"),
            rounded(mean(F.col("price")), 4).alias("avg_price"),
            total_if(_value(), _buy()).alias("buy_volume"),
            total_if(_value(), _sell()).alias("sell_volume"),
            rounded(mean(F.col("delta_t_ms")), 2).alias("avg_latency_ms"),
        )
    )
    return top(stats, "_volume", limit, "taker_address").drop("_volume")


def latency_per_minute(trades: DataFrame, market: str | None = None, span: tuple | None = None) -> DataFrame:
    out = (
        scoped(trades, market, None, span)
        .groupBy("condition_id", minute_of("exchange_ts").alias("time"))
        .agg(mean(F.col("delta_t_ms")).alias("avg_latency_ms"), F.max("delta_t_ms").alias("max_latency_ms"))
    )
    return out.orderBy("condition_id", "time")


def latency_overall(trades: DataFrame, market: str | None = None, span: tuple | None = None) -> DataFrame:
    return (
        with_book(scoped(trades, market, None, span), "delta_t_ms")
        .groupBy("condition_id")
        .agg(
            F.count(F.lit(1)).alias("total"),
            mean(F.col("delta_t_ms")).alias("avg_latency"),
            F.max("delta_t_ms").alias("max_latency"),
            F.min("delta_t_ms").alias("min_latency"),
        )
    )


def latency_points(
    trades: DataFrame, market: str | None = None, token: str | None = None, span: tuple | None = None, ordered: bool | None = None
) -> DataFrame:
    """Raw heat-map points, for a panel that bins them itself."""
    rows = with_book(scoped(trades, market, token, span), "delta_t_ms")
    out = rows.select(*TOKEN, "exchange_ts", minute_of("exchange_ts").alias("time"), F.col("delta_t_ms").alias("value"))
    return in_series_order(out, market, ordered, "exchange_ts", *TOKEN).drop("exchange_ts")


def latency_heatmap(
    trades: DataFrame,
    bin_ms: float = 50.0,
    every: str = "1 minute",
    market: str | None = None,
    token: str | None = None,
    span: tuple | None = None,
) -> DataFrame:
    """Trades per (minute, latency bin)."""
    rows = with_book(scoped(trades, market, token, span), "delta_t_ms")
    cell = (F.floor(F.col("delta_t_ms") / bin_ms) * bin_ms).cast("double")
    return heatmap(rows, every, cell, "latency_bin", F.count(F.lit(1)), "trades")


def trades_per_minute(trades: DataFrame, market: str | None = None, span: tuple | None = None) -> DataFrame:
    out = (
        scoped(trades, market, None, span)
        .groupBy(minute_of("exchange_ts").alias("time"))
        .agg(F.count(F.lit(1)).alias("trades"))
    )
    return out.orderBy("time")


def price_series(
    trades: DataFrame,
    market: str | None = None,
    token: str | None = None,
    span: tuple | None = None,
    limit: int | None = None,
    ordered: bool | None = None,
) -> DataFrame:
    """Trade prices in time order; the unscoped panel shows its first `limit` points."""
    out = scoped(trades, market, token, span).select(*TOKEN, "exchange_ts", "price", "trade_id")
    out = in_series_order(out, market, True if limit is not None else ordered, "exchange_ts", "trade_id")
    return out if limit is None else out.limit(limit)


def taker_stats(trades: DataFrame, market: str | None = None, span: tuple | None = None) -> DataFrame:
    return (
        non_empty(scoped(trades, market, None, span), "taker_address")
        .groupBy("condition_id")
        .agg(F.countDistinct("taker_address").alias("unique_takers"), F.count(F.lit(1)).alias("trades_with_taker"))
    )


def busiest_token(trades: DataFrame, as_of=None, hours: int = 24, limit: int = 1) -> DataFrame:
    """The (market, token) with the most trades."""
    counts = (
        lookback(trades, as_of, f"{hours} HOURS").groupBy(*TOKEN).agg(F.count(F.lit(1)).alias("trade_count"))
    )
    return top(counts, "trade_count", limit, *TOKEN)


def price_histogram(trades: DataFrame, col: str = "price", bins: int = 50, market: str | None = None) -> DataFrame:
    return histogram(optional_eq(trades, "condition_id", market), col, bins)


def trades_and_bbo(
    trades: DataFrame,
    levels: DataFrame,
    both_quoted: bool = False,
    market: str | None = None,
    token: str | None = None,
    span: tuple | None = None,
    ordered: bool | None = None,
) -> DataFrame:
    """Best quotes and trades on one axis: series ASK, BID, Quote Lifted (buys) and Bid Hit (sells).

    Two scans, one per table. The short-range panels show only quotes with both sides (`both_quoted`).
    """
    quotes = at_level(scoped(levels, market, token, span), 1)
    if both_quoted:
        quotes = with_book(quotes, "ask_px", "bid_px")
    points = F.stack(F.lit(2), F.lit("ASK"), F.col("ask_px"), F.lit("BID"), F.col("bid_px")).alias("series", "value")
    quotes = quotes.select(*TOKEN, "exchange_ts", points).filter(F.col("value").isNotNull())
    series = F.when(_buy(), "Quote Lifted").when(_sell(), "Bid Hit")
    hits = (
        scoped(trades, market, token, span)
        .filter(F.col("side").isin("BUY", "SELL"))
        .select(*TOKEN, "exchange_ts", series.alias("series"), F.col("price").alias("value"))
    )
    return in_series_order(quotes.unionByName(hits), market, ordered, *TOKEN, "exchange_ts", "series")
