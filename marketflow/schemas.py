"""Table schemas, defaults and JSON document schemas."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_S, _D, _F, _TS, _I16 = T.StringType(), T.DoubleType(), T.FloatType(), T.TimestampType(), T.ShortType()
_STRINGS = T.ArrayType(_S)

TRADES = _struct(
    ("exchange_ts", _TS, False),
    ("local_ts", _TS, False),
    ("delta_t_ms", _F, True),
    ("market_id", _S, False),
    ("condition_id", _S, False),
    ("token_id", _S, False),
    ("side", _S, False),
    ("price", _D, False),
    ("size", _D, False),
    ("outcome", _S, False),
    ("outcome_index", _I16, False),
    ("maker_address", _S, False),
    ("taker_address", _S, False),
    ("trade_id", _S, False),
    ("source", _S, False),
)

LEVELS = _struct(
    ("exchange_ts", _TS, False),
    ("local_ts", _TS, False),
    ("market_id", _S, False),
    ("condition_id", _S, False),
    ("token_id", _S, False),
    ("level", _I16, False),
    ("bid_px", _D, True),
    ("bid_sz", _D, True),
    ("ask_px", _D, True),
    ("ask_sz", _D, True),
    ("source", _S, False),
)

MARKETS = _struct(
    ("market_id", _S, False),
    ("condition_id", _S, False),
    ("event_id", _S, False),
    ("event_slug", _S, False),
    ("event_title", _S, False),
    ("event_start_date", _TS, True),
    ("event_end_date", _TS, True),
    ("event_tags", _STRINGS, False),
    ("question", _S, False),
    ("slug", _S, False),
    ("category", _S, False),
    ("computed_category", _S, False),
    ("outcomes", _STRINGS, False),
    ("clob_token_ids", _STRINGS, False),
    ("end_date", _TS, True),
    ("active", _I16, False),
    ("closed", _I16, False),
    ("volume_total", _D, False),
    ("liquidity", _D, False),
    ("best_bid", _D, False),
    ("best_ask", _D, False),
    ("last_trade_price", _D, False),
    ("updated_at", _TS, False),
)

BBO = _struct(
    ("ts_bucket", _TS, False),
    ("market_id", _S, False),
    ("condition_id", _S, False),
    ("token_id", _S, False),
    ("bid_px", _D, True),
    ("bid_sz", _D, True),
    ("ask_px", _D, True),
    ("ask_sz", _D, True),
    ("spread", _D, True),
    ("mid_px", _D, True),
)

TRADE_MINUTES = _struct(
    ("condition_id", _S, True),
    ("token_id", _S, True),
    ("minute", _TS, True),
    ("trades", T.LongType(), True),
    ("volume", _D, True),
    ("buy_volume", _D, True),
    ("sell_volume", _D, True),
    ("total_size", _D, True),
    ("min_price", _D, True),
    ("max_price", _D, True),
    ("first_trade", _TS, True),
    ("last_trade", _TS, True),
)

MINUTE_SKETCHES = _struct(
    ("minute", _TS, True),
    ("seen_in", _S, True),
    ("rows", T.LongType(), True),
    ("tokens", T.BinaryType(), True),
    ("markets", T.BinaryType(), True),
)

TABLES = {"trades_raw": TRADES, "orderbook_levels": LEVELS, "markets_dim": MARKETS}
ROLLUPS = {"trade_minutes": TRADE_MINUTES, "minute_sketches": MINUTE_SKETCHES}

# Written where a column is missing or null.
DEFAULTS = {
    "trades_raw": {
        "market_id": "",
        "condition_id": "",
        "token_id": "",
        "side": "UNKNOWN",
        "outcome": "",
        "outcome_index": 0,
        "maker_address": "",
        "taker_address": "",
        "trade_id": "",
        "source": "websocket",
    },
    "orderbook_levels": {"market_id": "", "condition_id": "", "token_id": "", "source": "websocket"},
    "markets_dim": {
        "event_id": "",
        "event_slug": "",
        "event_title": "",
        "event_tags": [],
        "question": "",
        "slug": "",
        "category": "Unknown",
        "computed_category": "Other",
        "outcomes": [],
        "clob_token_ids": [],
        "active": 1,
        "closed": 0,
        "volume_total": 0.0,
        "liquidity": 0.0,
        "best_bid": 0.0,
        "best_ask": 0.0,
        "last_trade_price": 0.0,
    },
}

# Columns the health checks ask for.
REQUIRED = {
    "trades_raw": ["exchange_ts", "local_ts", "delta_t_ms", "taker_address", "maker_address"],
    "orderbook_levels": ["exchange_ts", "local_ts", "level"],
}

SIDES = ("BUY", "SELL", "UNKNOWN")

# JSON documents. Fields that arrive either as a JSON string or as a nested value are read as strings:
# Spark's JSON reader keeps the raw text of a nested value when the field is declared a string.
MARKET_DOC = (
    "id string, conditionId string, clobTokenIds string, outcomes string, endDate string, events string, "
    "question string, slug string, category string, active string, closed string, volumeNum string, "
    "liquidityNum string, bestBid string, bestAsk string, lastTradePrice string"
)
EVENT_DOC = (
    "id string, slug string, title string, startDate string, endDate string, "
    "tags array<struct<label:string>>, markets array<string>"
)
TRADE_DOC = (
    "timestamp double, conditionId string, asset string, side string, price string, size string, "
    "outcome string, outcomeIndex int, transactionHash string, proxyWallet string"
)
BOOK_DOC = (
    "market string, asset_id string, bids array<struct<price:string,size:string>>, "
    "asks array<struct<price:string,size:string>>, last_trade_price string"
)
EVENT_REF = "array<struct<id:string,slug:string,title:string,startDate:string,endDate:string,tags:array<struct<label:string>>>>"
