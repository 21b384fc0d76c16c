"""Ingest transforms over messages that Spark derives from the driver tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import add
from marketflow.operators import feed
from marketflow.operators.book import book_levels, rank_book
from marketflow.sources.messages import explode_events
from marketflow.sources.texts import pack_titles

ORDER_TIES = ["l_orderkey", "l_linenumber", "l_suppkey"]


def _kind(messages: DataFrame, kind: str) -> DataFrame:
    return feed.classify(explode_events(messages)).filter(F.col("kind") == kind)


add(
    "feed_trades",
    lambda t: feed.normalize_trades(_kind(t.trade_messages, "trade")).drop("event"),
    """SELECT date_trunc('milliseconds', exchange_ts) AS exchange_ts, local_ts, condition_id AS market_id, condition_id,
              token_id, side, CAST(price AS DOUBLE) AS price, CAST(size AS DOUBLE) AS size, '' AS outcome,
              CAST(0 AS INTEGER) AS outcome_index, trade_id, '' AS maker_address, taker_address,
              'websocket' AS source, CAST(NULL AS VARCHAR) AS reject
       FROM trades WHERE event_type <> 'error'""",
    "trades",
)
add(
    "feed_book_levels",
    lambda t: feed.unfold_levels(feed.parse_books(_kind(t.book_messages, "book"))),
    """, sides AS (
         SELECT event_id, 'bid' AS side, CAST(0.4 - (i * 7 % 13) * 0.001 AS DECIMAL(9,3)) AS px, (event_id + i) % 5 AS sz
         FROM trades, (SELECT unnest(range(1, 13)) AS i)
         UNION ALL
         SELECT event_id, 'ask', CAST(0.5 + (i * 5 % 13) * 0.001 AS DECIMAL(9,3)), (event_id * i) % 7
         FROM trades, (SELECT unnest(range(1, 13)) AS i) WHERE i <= event_id % 13),
       ranked AS (
         SELECT *, row_number() OVER (PARTITION BY event_id, side
                                      ORDER BY CASE WHEN side = 'bid' THEN -px ELSE px END) AS level
         FROM sides WHERE sz <> 0)
       SELECT date_trunc('milliseconds', exchange_ts) AS exchange_ts, local_ts, condition_id AS market_id, condition_id,
              token_id, CAST(level AS INTEGER) AS level,
              CAST(max(px) FILTER (WHERE r.side = 'bid') AS DOUBLE) AS bid_px,
              CAST(max(sz) FILTER (WHERE r.side = 'bid') AS DOUBLE) AS bid_sz,
              CAST(max(px) FILTER (WHERE r.side = 'ask') AS DOUBLE) AS ask_px,
              CAST(max(sz) FILTER (WHERE r.side = 'ask') AS DOUBLE) AS ask_sz, 'websocket' AS source
       FROM ranked r JOIN trades t USING (event_id) WHERE level <= 10
       GROUP BY event_id, exchange_ts, local_ts, condition_id, token_id, level""",
    "trades",
)
_TYPES = """SELECT CASE event_type WHEN 'purchase' THEN 'trade' WHEN 'click' THEN 'unknown' WHEN 'view' THEN 'last_trade_price'
                   WHEN 'signup' THEN 'execution' ELSE 'price_change' END AS event_type, {0} FROM trades"""
add(
    "event_type_counts",
    lambda t: feed.event_type_counts(explode_events(t.trade_messages)),
    _TYPES.format("count(*) AS events") + " GROUP BY ALL",
    "trades",
)
add(
    "event_type_samples",
    lambda t: feed.event_type_samples(explode_events(t.trade_messages)).select("event_type", "receipt_ts"),
    f"""SELECT event_type, receipt_ts FROM (
          SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY receipt_ts) AS rn
          FROM ({_TYPES.format("local_ts AS receipt_ts")})) WHERE rn <= 3""",
    "trades",
)
_ORDERS = """
WITH orders AS (
  SELECT l_partkey AS snapshot, CASE WHEN l_linestatus = 'O' THEN 'bid' ELSE 'ask' END AS side, l_extendedprice AS price,
         l_quantity AS size, l_orderkey, l_linenumber, l_suppkey FROM lineitem),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY snapshot, side ORDER BY CASE WHEN side = 'bid' THEN -price ELSE price END,
                               l_orderkey, l_linenumber, l_suppkey) AS book_rank FROM orders)
"""
add(
    "ranked_book",
    lambda t: rank_book(t.orders, ["snapshot"], ORDER_TIES),
    _ORDERS + "SELECT * FROM ranked",
)
add(
    "book_levels_from_orders",
    lambda t: book_levels(t.orders, ["snapshot"], ORDER_TIES),
    _ORDERS
    + """SELECT snapshot, CAST(book_rank AS INTEGER) AS level, max(price) FILTER (WHERE side = 'bid') AS bid_px,
                max(size) FILTER (WHERE side = 'bid') AS bid_sz, max(price) FILTER (WHERE side = 'ask') AS ask_px,
                max(size) FILTER (WHERE side = 'ask') AS ask_sz
         FROM ranked WHERE book_rank <= 10 GROUP BY snapshot, book_rank""",
)
add(
    "packed_titles",
    lambda t: pack_titles(t.read("part").selectExpr("p_partkey AS title_id", "p_name AS title")),
    """SELECT (rn - 1) // 500 AS batch, count(*) AS titles,
              string_agg(concat(CAST(p_partkey AS VARCHAR), ': ', p_name), chr(10) ORDER BY rn) AS text
       FROM (SELECT *, row_number() OVER (ORDER BY p_partkey, p_name) AS rn FROM part) GROUP BY batch""",
)
