"""Order-book queries: series per snapshot and level, summaries per level, probabilities, depth.

Series of one market are in order; those of all markets are ordered only if `ordered` asks for it. Summaries compute
both sides in one aggregation per (market, token, level) and unfold the small result, instead of doubling the rows
before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions.aggregates import argmax, delta_from_min, mean, rounded
from marketflow.functions.metrics import (
    imbalance,
    level_label,
    level_text,
    liquidity,
    mid,
    minute_of,
    pressure,
    probability,
    spread,
    thousands,
)
from marketflow.operators.book import bbo_1s, both_sides
from marketflow.operators.dimension import with_yes_no
from marketflow.operators.distribution import heatmap
from marketflow.operators.filters import at_level, in_series_order, lookback, optional_eq, scoped, up_to_level, with_book
from marketflow.operators.joins import within_band

TOKEN = ["condition_id", "token_id"]
PX, SZ = ("bid_px", "ask_px"), ("bid_sz", "ask_sz")


def _last(x: Column) -> Column:
    """Newest value; rows of equal exchange time are settled by receipt time, then by value."""
    return argmax(x, F.col("exchange_ts"), F.col("local_ts"), x)


def _mid() -> Column:
    return mid(F.col("bid_px"), F.col("ask_px"))


def _spread() -> Column:
    return spread(F.col("bid_px"), F.col("ask_px"))


def _imbalance() -> Column:
    return imbalance(F.col("bid_sz"), F.col("ask_sz"))


def _liquidity() -> Column:
    return liquidity(F.col("bid_sz"), F.col("ask_sz"))


def bbo_df(levels: DataFrame, as_of=None, market: str | None = None, hours: int = 24) -> DataFrame:
    """1-second best bid and offer of the last hours."""
    # The first bound cuts the scan; the second is the bound on the bucket itself.
    rows = lookback(optional_eq(levels, "condition_id", market), as_of, f"{hours} HOURS")
    series = lookback(bbo_1s(rows), as_of, f"{hours} HOURS", inclusive=False, col="ts_bucket")
    return series.orderBy("ts_bucket", *TOKEN)


def _series(rows: DataFrame, value: Column, name: str, market, ordered) -> DataFrame:
    out = rows.select(*TOKEN, "exchange_ts", "level", value.cast("double").alias(name))
    return in_series_order(out, market, ordered, *TOKEN, "exchange_ts", "level")


def price_levels(levels: DataFrame, market=None, token=None, span=None, ordered: bool | None = None) -> DataFrame:
    rows = scoped(levels, market, token, span)
    out = rows.select(*TOKEN, "exchange_ts", "level", "bid_px", "ask_px")
    return in_series_order(out, market, ordered, *TOKEN, "exchange_ts", "level")


def size_levels(levels: DataFrame, market=None, token=None, span=None, ordered: bool | None = None) -> DataFrame:
    rows = scoped(levels, market, token, span)
    out = rows.select(*TOKEN, "exchange_ts", "level", "bid_sz", "ask_sz")
    return in_series_order(out, market, ordered, *TOKEN, "exchange_ts", "level")


def labelled_levels(
    levels: DataFrame, what: str = "price", depth: int = 3, market=None, token=None, span=None, ordered: bool | None = None
) -> DataFrame:
    """The chart series of the first `depth` levels, one row per side and present value. `what`: price or size."""
    bid, ask = PX if what == "price" else SZ
    suffix = "" if what == "price" else "_size"
    rows = both_sides(up_to_level(scoped(levels, market, token, span), depth), bid, ask)
    label = F.when(F.col("side") == "bid", level_label(F.col("level"), f"bid{suffix}")).otherwise(
        level_label(F.col("level"), f"ask{suffix}")
    )
    out = rows.select(*TOKEN, "exchange_ts", label.alias("series"), "value")
    return in_series_order(out, market, ordered, *TOKEN, "exchange_ts", "series")


def _two_sided(levels: DataFrame, bid: str, ask: str, labels: tuple, columns) -> DataFrame:
    """Both sides' statistics per (market, token, level) in one pass, then one row per side that has values."""
    sides = (("bid", bid), ("ask", ask))
    grouped = levels.groupBy(*TOKEN, "level").agg(
        *[F.struct(F.count(col).alias("n"), *columns(F.col(col))).alias(side) for side, col in sides]
    )
    unfolded = F.stack(F.lit(2), F.lit("bid"), F.col("bid"), F.lit("ask"), F.col("ask")).alias("side", "s")
    name = F.when(F.col("side") == "bid", level_label(F.col("level"), labels[0])).otherwise(
        level_label(F.col("level"), labels[1])
    )
    stats = grouped.select(*TOKEN, "level", unfolded).filter(F.col("s.n") > 0)
    return stats.select(*TOKEN, "level", "side", name.alias("name"), "s.*").drop("n").orderBy(*TOKEN, "level", "side")


def price_summary(levels: DataFrame, market=None, token=None, span=None) -> DataFrame:
    def columns(x: Column) -> list[Column]:
        return [
            _last(x).alias("last"),
            rounded(mean(x), 4).alias("mean"),
            F.max(x).alias("max"),
            F.min(x).alias("min"),
        ]

    return _two_sided(scoped(levels, market, token, span), *PX, ("bid", "ask"), columns)


def size_summary(levels: DataFrame, market=None, token=None, span=None) -> DataFrame:
    def columns(x: Column) -> list[Column]:
        return [
            _last(x).alias("last"),
            rounded(mean(x), 2).alias("mean"),
            rounded(F.sum(x), 0).alias("total"),
        ]

    return _two_sided(scoped(levels, market, token, span), *SZ, ("bid_size", "ask_size"), columns)


def _summary(rows: DataFrame, metric: str, *columns: Column) -> DataFrame:
    name = level_label(F.col("level"), metric).alias("name")
    return rows.groupBy(*TOKEN, "level").agg(*columns).select("*", name).orderBy(*TOKEN, "level")


def mid_series(levels: DataFrame, market=None, token=None, span=None, ordered: bool | None = None) -> DataFrame:
    return _series(with_book(scoped(levels, market, token, span), *PX), _mid(), "mid", market, ordered)


def mid_summary(levels: DataFrame, market=None, token=None, span=None) -> DataFrame:
    return _summary(
        with_book(scoped(levels, market, token, span), *PX),
        "mid",
        _last(_mid()).cast("double").alias("last"),
        rounded(mean(_mid()), 4).alias("mean"),
        rounded(delta_from_min(_mid(), F.col("exchange_ts"), F.col("local_ts"), _mid()), 4).alias("delta"),
    )


def imbalance_series(levels: DataFrame, market=None, token=None, span=None, ordered: bool | None = None) -> DataFrame:
    return _series(with_book(scoped(levels, market, token, span), *SZ), _imbalance(), "imbalance", market, ordered)


def imbalance_summary(levels: DataFrame, market=None, token=None, span=None) -> DataFrame:
    return _summary(
        with_book(scoped(levels, market, token, span), *SZ),
        "imbalance",
        _last(_imbalance()).alias("last"),
        rounded(mean(_imbalance()), 4).alias("mean"),
        F.max(_imbalance()).alias("max"),
        F.min(_imbalance()).alias("min"),
    )


def spread_series(levels: DataFrame, market=None, token=None, span=None, ordered: bool | None = None) -> DataFrame:
    return _series(with_book(scoped(levels, market, token, span), *PX), _spread(), "spread", market, ordered)


def spread_summary(levels: DataFrame, market=None, token=None, span=None) -> DataFrame:
    return _summary(
        with_book(scoped(levels, market, token, span), *PX),
        "spread",
        _last(_spread()).cast("double").alias("last"),
        rounded(mean(_spread()), 4).alias("mean"),
        F.max(_spread()).cast("double").alias("max"),
    )


def liquidity_series(levels: DataFrame, market=None, token=None, span=None, ordered: bool | None = None) -> DataFrame:
    return _series(with_book(scoped(levels, market, token, span), *SZ), _liquidity(), "liquidity", market, ordered)


def liquidity_summary(levels: DataFrame, market=None, token=None, span=None) -> DataFrame:
    return _summary(
        with_book(scoped(levels, market, token, span), *SZ),
        "liquidity",
        _last(_liquidity()).cast("double").alias("last"),
        rounded(mean(_liquidity()), 0).alias("mean"),
        F.min(_liquidity()).cast("double").alias("min"),
    )


def _touch(levels: DataFrame, columns: tuple, market, token, span) -> DataFrame:
    """Level-1 rows with the named columns present."""
    return with_book(at_level(scoped(levels, market, token, span), 1), *columns)


def probability_series(levels: DataFrame, market=None, token=None, span=None, ordered: bool | None = None) -> DataFrame:
    """YES (mid) and NO (1 − mid) series from level 1."""
    rows = _touch(levels, PX, market, token, span).select(*TOKEN, "exchange_ts", _mid().cast("double").alias("mid"))
    sides = F.stack(
        F.lit(2), F.lit("YES Probability"), F.col("mid"), F.lit("NO Probability"), 1 - F.col("mid")
    ).alias("series", "value")
    return in_series_order(rows.select(*TOKEN, "exchange_ts", sides), market, ordered, *TOKEN, "exchange_ts", "series")


def current_probability(levels: DataFrame, market=None, token=None, span=None) -> DataFrame:
    """Newest YES and NO probability in percent, per token."""
    last = _touch(levels, PX, market, token, span).groupBy(*TOKEN).agg(_last(_mid()).alias("mid"))
    sides = F.stack(
        F.lit(2),
        F.lit("YES Probability"),
        probability(F.col("mid")),
        F.lit("NO Probability"),
        probability(F.col("mid"), yes=False),
    ).alias("name", "value")
    return last.select(*TOKEN, sides)


def market_pressure(levels: DataFrame, market=None, token=None, span=None) -> DataFrame:
    """Mean level-1 imbalance and its label."""
    value = _touch(levels, SZ, market, token, span).groupBy(*TOKEN).agg(mean(_imbalance()).alias("avg_imbalance"))
    return value.select("*", pressure(F.col("avg_imbalance")).alias("pressure"))


def unified_yes_axis(levels: DataFrame, markets: DataFrame, market=None, span=None, ordered: bool | None = None) -> DataFrame:
    """Level-1 mids of both tokens on the YES axis: first token mid, second 1 − mid, any other null."""
    rows = with_yes_no(
        _touch(levels, PX, market, None, span).select(*TOKEN, "exchange_ts", "level", _mid().cast("double").alias("mid")),
        markets,
    )
    yes = F.when(F.col("token_id") == F.col("yes_token"), F.col("mid")).when(
        F.col("token_id") == F.col("no_token"), 1 - F.col("mid")
    )
    out = rows.select(*TOKEN, "exchange_ts", "level", yes.alias("yes_probability"))
    return in_series_order(out, market, ordered, "condition_id", "exchange_ts", "token_id")


def ask_depth(levels: DataFrame, band: float = 0.10, market=None, token=None, span=None, ordered: bool | None = None) -> DataFrame:
    """Asks within `band` of the touch, in thousands of shares, per snapshot."""
    depth = within_band(scoped(levels, market, token, span), band)
    out = depth.select(*TOKEN, "exchange_ts", thousands(F.col("depth")).alias("ask_depth"))
    return in_series_order(out, market, ordered, *TOKEN, "exchange_ts")


def depth_points(levels: DataFrame, market=None, token=None, span=None, depth: int = 10, ordered: bool | None = None) -> DataFrame:
    """Raw depth heat-map points: minute, level as text, liquidity."""
    rows = with_book(up_to_level(scoped(levels, market, token, span), depth), *SZ)
    out = rows.select(
        *TOKEN,
        "exchange_ts",
        F.col("level").alias("_level"),
        minute_of("exchange_ts").alias("time"),
        level_text(F.col("level")).alias("level"),
        _liquidity().cast("double").alias("liquidity"),
    )
    return in_series_order(out, market, ordered, "exchange_ts", *TOKEN, "_level").drop("exchange_ts", "_level")


def depth_heatmap(levels: DataFrame, every: str = "1 minute", market=None, token=None, span=None, depth: int = 10) -> DataFrame:
    """Liquidity summed per (minute, level)."""
    rows = with_book(up_to_level(scoped(levels, market, token, span), depth), *SZ)
    return heatmap(rows, every, level_text(F.col("level")), "level", F.sum(_liquidity()).cast("double"), "liquidity")


def book_updates_per_minute(levels: DataFrame, market=None, span=None) -> DataFrame:
    out = (
        at_level(scoped(levels, market, None, span), 1)
        .groupBy(minute_of("exchange_ts").alias("time"))
        .agg(F.count(F.lit(1)).alias("orderbook_updates"))
    )
    return out.orderBy("time")


def quote_series(levels: DataFrame, market=None, span=None, ordered: bool | None = None) -> DataFrame:
    """Level-1 quotes of all tokens of a market that have a bid."""
    rows = _touch(levels, ("bid_px",), market, None, span)
    out = rows.select(*TOKEN, "exchange_ts", "level", "bid_px", "ask_px")
    return in_series_order(out, market, ordered, *TOKEN, "exchange_ts")


def level_stats(levels: DataFrame, market=None, token=None, span=None) -> DataFrame:
    return (
        scoped(levels, market, token, span)
        .groupBy(*TOKEN)
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.max("level").alias("max_level"),
            F.countDistinct("level").alias("unique_levels"),
        )
    )
