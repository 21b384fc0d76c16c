"""Document transforms, the rows the writers store, and the live aggregates on whole tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import BUY, SELL, TOK, add, half_even
from checks.tables import Tables
from marketflow import schemas
from marketflow.sources import documents, tables
from marketflow.streaming import live


def _documents(t: Tables, text: str, schema: str, **inputs: DataFrame) -> DataFrame:
    """JSON documents that Spark derives from a driver table, parsed with the document schema."""
    return t.spark.sql(text, **inputs).select(F.from_json("value", schema).alias("d")).select("d.*")


_MARKET_DOCS = """
SELECT to_json(named_struct(
  'id', p_partkey, 'conditionId', concat('c', p_partkey),
  'clobTokenIds', to_json(array(concat('c', p_partkey, '-0'), concat('c', p_partkey, '-1'))),
  'outcomes', array('Yes', 'No'),
  'endDate', CASE WHEN p_partkey % 4 = 0 THEN 'unknown'
                  ELSE concat('2025-01-', lpad(CAST(1 + p_partkey % 28 AS STRING), 2, '0'), 'T12:30:00Z') END,
  'events', array(named_struct('id', p_size, 'slug', lower(p_brand), 'title', p_brand,
                               'tags', array(named_struct('label', p_type), named_struct('label', '')))),
  'question', p_name, 'slug', replace(p_name, ' ', '-'), 'category', CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END,
  'active', p_partkey % 2 = 0, 'closed', p_partkey % 5 = 0,
  'volumeNum', p_retailprice, 'liquidityNum', CAST(p_size AS STRING), 'bestBid', CASE WHEN p_size % 2 = 0 THEN 0.25D END)) AS value
FROM {part}
"""
add(
    "market_documents",
    lambda t: documents.transform_markets(_documents(t, _MARKET_DOCS, schemas.MARKET_DOC, part=t.read("part"))).withColumns(
        {c: F.array_join(c, "|") for c in ("event_tags", "outcomes", "clob_token_ids")}
    ),
    """SELECT CAST(p_partkey AS VARCHAR) AS market_id, concat('c', p_partkey) AS condition_id,
              CAST(p_size AS VARCHAR) AS event_id, lower(p_brand) AS event_slug, p_brand AS event_title,
              CAST(NULL AS TIMESTAMP) AS event_start_date, CAST(NULL AS TIMESTAMP) AS event_end_date, p_type AS event_tags,
              p_name AS question, replace(p_name, ' ', '-') AS slug,
              CASE WHEN p_partkey % 3 = 0 THEN 'Unknown' ELSE p_type END AS category, 'Yes|No' AS outcomes,
              concat('c', p_partkey, '-0|c', p_partkey, '-1') AS clob_token_ids,
              CASE WHEN p_partkey % 4 <> 0 THEN make_timestamp(2025, 1, 1 + p_partkey % 28, 12, 30, 0) END AS end_date,
              CAST(CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS INT) AS active,
              CAST(CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS INT) AS closed,
              p_retailprice AS volume_total, CAST(p_size AS DOUBLE) AS liquidity,
              CAST(CASE WHEN p_size % 2 = 0 THEN 0.25 ELSE 0 END AS DOUBLE) AS best_bid,
              CAST(0 AS DOUBLE) AS best_ask, CAST(0 AS DOUBLE) AS last_trade_price
       FROM part""",
)
_EVENT_DOCS = """
SELECT to_json(named_struct('id', o_orderkey, 'slug', o_orderstatus, 'title', o_orderpriority,
  'startDate', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
  'tags', array(named_struct('label', o_orderpriority)), 'markets', array(named_struct('id', o_custkey)))) AS value
FROM {orders}
"""
add(
    "event_documents",
    lambda t: documents.transform_events(_documents(t, _EVENT_DOCS, schemas.EVENT_DOC, orders=t.read("orders"))).withColumns(
        {c: F.array_join(c, "|") for c in ("event_tags", "markets")}
    ),
    """SELECT CAST(o_orderkey AS VARCHAR) AS event_id, o_orderstatus AS event_slug, o_orderpriority AS event_title,
              CAST(o_orderdate AS TIMESTAMP) AS event_start_date, CAST(NULL AS TIMESTAMP) AS event_end_date,
              o_orderpriority AS event_tags, concat('{"id":', o_custkey, '}') AS markets FROM orders""",
)
_TRADE_DOCS = """
SELECT to_json(named_struct('timestamp', unix_seconds(exchange_ts), 'conditionId', condition_id, 'asset', token_id,
  'side', side, 'price', price, 'size', CAST(size AS STRING), 'outcomeIndex', event_id % 2,
  'transactionHash', trade_id, 'proxyWallet', taker_address)) AS value
FROM {trades}
"""
add(
    "historic_trade_documents",
    lambda t: documents.transform_rest_trades(_documents(t, _TRADE_DOCS, schemas.TRADE_DOC, trades=t.trades)),
    """SELECT date_trunc('second', exchange_ts) AS exchange_ts, '' AS market_id, condition_id, token_id, side,
              CAST(price AS DOUBLE) AS price, CAST(size AS DOUBLE) AS size, '' AS outcome,
              CAST(event_id % 2 AS INT) AS outcome_index, trade_id, CAST(NULL AS VARCHAR) AS maker_address, taker_address,
              'data_api' AS source FROM trades""",
    "trades",
)
_BOOK_DOCS = """
SELECT to_json(named_struct('market', condition_id, 'asset_id', token_id,
  'bids', transform(sequence(1, 5), i -> named_struct('price', CAST(CAST(0.4 - (i * 3 % 5) * 0.01 AS DECIMAL(9,3)) AS STRING),
                                                      'size', CAST(event_id + i AS STRING))),
  'asks', transform(filter(sequence(1, 5), i -> i <= event_id % 6), i -> named_struct(
     'price', CAST(CAST(0.5 + (i * 2 % 5) * 0.01 AS DECIMAL(9,3)) AS STRING), 'size', CAST(event_id * i AS STRING))),
  'last_trade_price', CAST(price AS STRING))) AS value
FROM {trades}
"""
add(
    "book_documents",
    lambda t: documents.transform_rest_books(
        _documents(t, _BOOK_DOCS, schemas.BOOK_DOC, trades=t.trades), now=F.lit("2024-02-01").cast("timestamp")
    ),
    """, asks AS (SELECT event_id, CAST(0.5 + (i * 2 % 5) * 0.01 AS DECIMAL(9,3)) AS px, event_id * i AS sz
                  FROM trades, (SELECT unnest(range(1, 6)) AS i) WHERE i <= event_id % 6),
         bids AS (SELECT event_id, CAST(0.4 - (i * 3 % 5) * 0.01 AS DECIMAL(9,3)) AS px, event_id + i AS sz
                  FROM trades, (SELECT unnest(range(1, 6)) AS i)),
         best_ask AS (SELECT event_id, min(px) AS px, arg_min(sz, px) AS sz FROM asks GROUP BY event_id),
         best_bid AS (SELECT event_id, max(px) AS px, arg_max(sz, px) AS sz FROM bids GROUP BY event_id)
       SELECT TIMESTAMP '2024-02-01' AS exchange_ts, condition_id AS market_id, condition_id, token_id,
              CAST(b.px AS DOUBLE) AS bid_px, CAST(b.sz AS DOUBLE) AS bid_sz, CAST(a.px AS DOUBLE) AS ask_px,
              CAST(a.sz AS DOUBLE) AS ask_sz, CAST(t.price AS DOUBLE) AS last_trade_price, 'clob_rest' AS source
       FROM trades t LEFT JOIN best_bid b USING (event_id) LEFT JOIN best_ask a USING (event_id)""",
    "trades",
)

# What the writers store.
add(
    "stored_trades",
    lambda t: tables.prepare_trades(t.trades),
    """SELECT exchange_ts, local_ts, CAST(epoch_ms(local_ts) - epoch_ms(exchange_ts) AS FLOAT) AS delta_t_ms, market_id,
              condition_id, token_id, side, CAST(price AS DOUBLE) AS price, CAST(size AS DOUBLE) AS size, '' AS outcome,
              CAST(0 AS INT) AS outcome_index, '' AS maker_address, taker_address, trade_id, 'websocket' AS source
       FROM trades""",
    "trades",
)
add(
    "stored_levels",
    lambda t: tables.prepare_levels(t.levels),
    """SELECT exchange_ts, local_ts, market_id, condition_id, token_id, level, CAST(bid_px AS DOUBLE) AS bid_px,
              CAST(bid_sz AS DOUBLE) AS bid_sz, CAST(ask_px AS DOUBLE) AS ask_px, CAST(ask_sz AS DOUBLE) AS ask_sz,
              'websocket' AS source
       FROM levels WHERE coalesce(bid_px, bid_sz, ask_px, ask_sz) IS NOT NULL""",
    "levels",
)
add(
    "compacted_markets",
    lambda t: tables.compact_markets(tables.align_schema(t.markets, "markets_dim")).drop(
        "event_tags", "outcomes", "clob_token_ids"
    ),
    """SELECT market_id, condition_id, event_id, '' AS event_slug, event_title, CAST(NULL AS TIMESTAMP) AS event_start_date,
              CAST(NULL AS TIMESTAMP) AS event_end_date, question, '' AS slug, category, computed_category,
              CAST(NULL AS TIMESTAMP) AS end_date, active, closed, volume_total, CAST(0 AS DOUBLE) AS liquidity,
              CAST(0 AS DOUBLE) AS best_bid, CAST(0 AS DOUBLE) AS best_ask, CAST(0 AS DOUBLE) AS last_trade_price, updated_at
       FROM latest""",
    "latest",
)

# The live aggregates, on the whole table as one batch.
add(
    "live_trade_counts",
    lambda t: live.stream_counts(t.trades),
    "SELECT date_trunc('minute', exchange_ts) AS time, count(*) AS \"rows\" FROM trades GROUP BY ALL",
    "trades",
)
add(
    "live_volume",
    lambda t: live.stream_volume(t.trades, "5 seconds"),
    f"""SELECT {TOK}, time_bucket(INTERVAL '5 seconds', exchange_ts) AS time, {BUY} AS buy_volume, {SELL} AS sell_volume
        FROM trades GROUP BY ALL""",
    "trades",
)
_TWICE = "CAST(bid_px + ask_px AS DOUBLE)"
add(
    "live_quotes",
    lambda t: live.stream_quotes(t.levels),
    f"""SELECT {TOK}, exchange_ts, CAST(bid_px AS DOUBLE) AS bid_px, CAST(ask_px AS DOUBLE) AS ask_px,
               {half_even(f"{_TWICE} * 50", 2)} AS yes_pct, {half_even(f"100 - {_TWICE} * 50", 2)} AS no_pct
        FROM (SELECT *, row_number() OVER (PARTITION BY {TOK} ORDER BY exchange_ts DESC) AS rn FROM levels
              WHERE level = 1 AND bid_px IS NOT NULL AND ask_px IS NOT NULL) WHERE rn = 1""",
    "levels",
)
