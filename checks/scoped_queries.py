"""The dashboard selectors: one market, one token, a closed time range. The market is the one with a third of all rows."""

from checks.registry import BUY, SELL, TOK, VALUE, add
from marketflow.operators.filters import scoped
from marketflow.plans import book, trades

MARKET, TOKEN = "c0", "c0-1"
SPAN = ("2024-01-05 06:00:00", "2024-01-19 18:30:00")
IN_SPAN = f"exchange_ts BETWEEN TIMESTAMP '{SPAN[0]}' AND TIMESTAMP '{SPAN[1]}'"
SCOPE = f"condition_id = '{MARKET}' AND token_id = '{TOKEN}' AND {IN_SPAN}"
ONE = {"market": MARKET, "token": TOKEN, "span": SPAN}
BOTH = "bid_{0} IS NOT NULL AND ask_{0} IS NOT NULL"

add(
    "scoped_trades",
    lambda t: scoped(t.trades, **ONE).select("trade_id", "exchange_ts", "side", "price", "size"),
    f"""SELECT trade_id, exchange_ts, side, CAST(price AS DOUBLE) AS price, CAST(size AS DOUBLE) AS size
        FROM trades WHERE {SCOPE}""",
    "trades",
)
add(
    "scoped_bucket_volume",
    lambda t: trades.bucket_volume(t.trades, "1 hour", **ONE),
    f"""SELECT {TOK}, time_bucket(INTERVAL '1 hour', exchange_ts) AS time, {BUY} AS buy_volume, {SELL} AS sell_volume
        FROM trades WHERE {SCOPE} GROUP BY ALL""",
    "trades",
)
add(
    "scoped_bucket_total",
    lambda t: trades.bucket_total(t.trades, "6 hours", **ONE),
    f"""SELECT {TOK}, time_bucket(INTERVAL '6 hours', exchange_ts) AS time, CAST(sum({VALUE}) AS DOUBLE) AS volume
        FROM trades WHERE {SCOPE} GROUP BY ALL""",
    "trades",
)
add(
    "scoped_cumulative_volume",
    lambda t: trades.cumulative_volume(t.trades, **ONE),
    f"""SELECT {TOK}, exchange_ts, CAST(sum({VALUE}) OVER (ORDER BY exchange_ts
               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cum_volume FROM trades WHERE {SCOPE}""",
    "trades",
)
add(
    "scoped_trades_per_minute",
    lambda t: trades.trades_per_minute(t.trades, MARKET, SPAN),
    f"""SELECT date_trunc('minute', exchange_ts) AS time, count(*) AS trades FROM trades
        WHERE condition_id = '{MARKET}' AND {IN_SPAN} GROUP BY ALL""",
    "trades",
)
add(
    "scoped_mid_series",
    lambda t: book.mid_series(t.levels, **ONE),
    f"""SELECT {TOK}, exchange_ts, level, CAST(bid_px + ask_px AS DOUBLE) / 2 AS mid FROM levels
        WHERE {SCOPE} AND {BOTH.format("px")}""",
    "levels",
)
add(
    "scoped_depth_heatmap",
    lambda t: book.depth_heatmap(t.levels, "6 hours", **ONE),
    f"""SELECT {TOK}, time_bucket(INTERVAL '6 hours', exchange_ts) AS time, CAST(level AS VARCHAR) AS level,
               CAST(sum(bid_sz + ask_sz) AS DOUBLE) AS liquidity FROM levels
        WHERE {SCOPE} AND level <= 10 AND {BOTH.format("sz")} GROUP BY ALL""",
    "levels",
)
add(
    "scoped_level_stats",
    lambda t: book.level_stats(t.levels, **ONE),
    f"""SELECT {TOK}, count(*) AS total, max(level) AS max_level, count(DISTINCT level) AS unique_levels
        FROM levels WHERE {SCOPE} GROUP BY ALL""",
    "levels",
)
add(
    "quoted_token",
    lambda t: scoped(t.trades, "c0' OR 'a' = 'a").select("trade_id").unionByName(scoped(t.trades, token="c0-0").select("trade_id")),
    "SELECT trade_id FROM trades WHERE condition_id = 'c0'' OR ''a'' = ''a' OR token_id = 'c0-0'",
    "trades",
)
