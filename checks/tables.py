"""The stored tables, derived from the driver tables: the same SQL text for Spark and for the check engine.

Every projection reads all rows. One market ('c0') takes a third of all trades and book rows, so every plan
is exercised with a hot key; a tenth of the trades belong to markets that the dimension does not know.
Prices and sizes are decimals here, which makes sums and means repeatable to the last digit.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.operators.dimension import SPORTS_KEYWORDS, computed_category
from marketflow.session import configure

KEY = """CASE WHEN event_id % 3 = 0 THEN '0'
             WHEN event_id % 10 = 4 THEN concat('x', CAST(user_id AS STRING))
             ELSE CAST(user_id AS STRING) END"""

TRADES = f"""
SELECT ts AS exchange_ts, ts + INTERVAL 1 MILLISECOND * (10 + (event_id * 37) % 490) AS local_ts,
       CAST(10 + (event_id * 37) % 490 AS FLOAT) AS delta_t_ms,
       concat('m', k) AS market_id, concat('c', k) AS condition_id,
       concat('c', k, '-', CAST(event_id % 2 AS STRING)) AS token_id,
       CASE WHEN event_type IN ('purchase', 'click') THEN 'BUY'
            WHEN event_type IN ('signup', 'view') THEN 'SELL' ELSE 'UNKNOWN' END AS side,
       CAST(CAST((event_id * 7919) % 999 + 1 AS DOUBLE) / CAST(1000 AS DOUBLE) AS DECIMAL(9,3)) AS price,
       CAST(value AS DECIMAL(18,2)) AS size,
       CASE WHEN event_id % 10 = 0 THEN '' ELSE concat('u', CAST(user_id AS STRING)) END AS taker_address,
       concat('t', CAST(event_id AS STRING)) AS trade_id, event_id, event_type
FROM (SELECT *, {KEY} AS k FROM <events>) AS e
"""


def _px(sign: str) -> str:
    cents = f"300 + (event_id * 31) % 400 {sign} level * (1 + event_id % 25)"
    return f"CAST(CAST({cents} AS DOUBLE) / CAST(1000 AS DOUBLE) AS DECIMAL(9,3))"


LEVELS = f"""
SELECT ts AS exchange_ts, ts + INTERVAL 1 MILLISECOND * (10 + (event_id * 37) % 490) AS local_ts,
       concat('m', k) AS market_id, concat('c', k) AS condition_id,
       concat('c', k, '-', CAST(event_id % 2 AS STRING)) AS token_id, level,
       CASE WHEN (event_id + level) % 13 <> 0 THEN {_px('-')} END AS bid_px,
       CASE WHEN (event_id + level) % 13 <> 0 THEN CAST(100 + (event_id * level) % 900 AS DECIMAL(18,2)) END AS bid_sz,
       CASE WHEN (event_id + level) % 17 <> 0 THEN {_px('+')} END AS ask_px,
       CASE WHEN (event_id + level) % 17 <> 0 THEN CAST(50 + (event_id * level * 7) % 950 AS DECIMAL(18,2)) END AS ask_sz
FROM (SELECT *, {KEY} AS k, <explode 1 10> AS level FROM <events>) AS e
"""

MARKETS = """
SELECT concat('m', CAST(p_partkey AS STRING)) AS market_id, concat('c', CAST(p_partkey AS STRING)) AS condition_id,
       CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('e', CAST(CAST(floor(p_partkey / 4) AS BIGINT) AS STRING)) END
         AS event_id,
       concat('Event ', CAST(CAST(floor(p_partkey / 4) AS BIGINT) AS STRING), ' r', CAST(v AS STRING)) AS event_title,
       CASE WHEN p_partkey % 6 = 0 THEN concat(p_name, ' vs ', p_brand, ' r', CAST(v AS STRING))
            ELSE concat(p_name, ' ', CAST(p_partkey AS STRING), ' r', CAST(v AS STRING)) END AS question,
       CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 9 = 0 THEN 'Sports' ELSE p_type END AS category,
       <array concat('c', CAST(p_partkey AS STRING), '-0'), concat('c', CAST(p_partkey AS STRING), '-1')>
         AS clob_token_ids,
       p_retailprice + v AS volume_total,
       CASE WHEN (p_partkey + v) % 5 = 0 THEN 0 ELSE 1 END AS active, CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS closed,
       TIMESTAMP '2024-01-30 12:00:00' + INTERVAL 1 HOUR * (6 * v - 24 * (p_partkey % 3)) AS updated_at
FROM (SELECT *, <explode 0 2> AS v FROM <part>) AS p
"""

TRADE_MESSAGES = """
SELECT local_ts AS receipt_ts, CASE event_type
  WHEN 'purchase' THEN to_json(named_struct('event_type', 'trade', 'timestamp', unix_millis(exchange_ts),
    'asset_id', token_id, 'market', condition_id, 'side', side, 'price', CAST(price AS STRING),
    'size', CAST(size AS STRING), 'id', trade_id, 'taker', taker_address))
  WHEN 'click' THEN to_json(named_struct('timestamp', 0, 'ts', unix_millis(exchange_ts), 'asset', token_id,
    'condition_id', condition_id, 'side', side, 'price', price, 'size', size, 'trade_id', trade_id,
    'taker', taker_address))
  WHEN 'view' THEN to_json(named_struct('type', 'last_trade_price',
    'timestamp', CAST(unix_millis(exchange_ts) AS STRING), 'asset_id', token_id, 'market', condition_id,
    'side', side, 'price', CAST(price AS STRING), 'size', size, 'id', trade_id, 'taker', taker_address))
  WHEN 'signup' THEN to_json(array(named_struct('event_type', '', 'type', 'execution', 'ts', unix_millis(exchange_ts),
    'asset_id', token_id, 'market', condition_id, 'side', side, 'price', price, 'size', CAST(size AS STRING),
    'id', trade_id, 'taker', taker_address)))
  ELSE to_json(named_struct('event_type', 'price_change', 'asset_id', token_id, 'price', price)) END AS value
FROM {trades}
"""
BOOK_MESSAGES = """
SELECT local_ts AS receipt_ts, to_json(named_struct('event_type', 'book', 'timestamp', unix_millis(exchange_ts),
  'asset_id', token_id, 'market', condition_id,
  'bids', transform(sequence(1, 12), i -> named_struct(
     'price', CAST(CAST(0.4 - (i * 7 % 13) * 0.001 AS DECIMAL(9,3)) AS STRING), 'size', (event_id + i) % 5)),
  'asks', transform(filter(sequence(1, 12), i -> i <= event_id % 13), i -> named_struct(
     'price', CAST(0.5 + (i * 5 % 13) * 0.001 AS DECIMAL(9,3)), 'size', (event_id * i) % 7)))) AS value
FROM {trades}
"""

CATEGORY_MAP = "SELECT concat('m', CAST(c_custkey AS STRING)) AS market_id, c_mktsegment AS category FROM <customer>"


def _fill(text: str, spark: bool) -> str:
    out = text
    for table in ("events", "part", "customer"):
        out = out.replace(f"<{table}>", "{" + table + "}" if spark else table)
    out = out.replace("<explode 1 10>", "explode(sequence(1, 10))" if spark else "CAST(unnest(range(1, 11)) AS INT)")
    out = out.replace("<explode 0 2>", "explode(sequence(0, 2))" if spark else "CAST(unnest(range(0, 3)) AS INT)")
    if "<array " in out:
        head, rest = out.split("<array ", 1)
        body, tail = rest.split(">", 1)
        out = f"{head}array({body}){tail}" if spark else f"{head}[{body}]{tail}"
    return out


def _spark_sql(text: str) -> str:
    return _fill(text, True)


# SQL of the derived tables, for `WITH`.
SQL = {name: _fill(text, False) for name, text in (("trades", TRADES), ("levels", LEVELS), ("raw_markets", MARKETS), ("category_map", CATEGORY_MAP))}
_SPORTS = " OR ".join(f"contains(lower(question), '{word}')" for word in SPORTS_KEYWORDS)
SQL["markets"] = f"""
SELECT m.*, coalesce(nullif(c.category, ''),
                     nullif(CASE WHEN m.category = 'Sports' OR {_SPORTS} THEN 'Sports' ELSE m.category END, ''),
                     'Other') AS computed_category
FROM raw_markets m LEFT JOIN category_map c ON m.market_id = c.market_id
"""
SQL["latest"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY condition_id ORDER BY updated_at DESC) AS rn FROM markets)
WHERE rn = 1
"""
NEEDS = {"markets": ("raw_markets", "category_map"), "latest": ("raw_markets", "category_map", "markets")}


def with_tables(body: str, *tables: str) -> str:
    """Prefix `body` with the derived tables it reads."""
    names: list[str] = []
    for table in tables:
        for name in (*NEEDS.get(table, ()), table):
            if name not in names:
                names.append(name)
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n" + body


class Tables:
    """The stored tables as DataFrames over one driver directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = configure(spark), sf_dir

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        # The explicit schema reads the zone-less file column as a UTC timestamp, so that time filters reach the scan.
        return self.read("events", "event_id bigint, ts timestamp, user_id bigint, event_type string, value double")

    @cached_property
    def trades(self) -> DataFrame:
        return self.spark.sql(_spark_sql(TRADES), events=self.events)

    @cached_property
    def tied_trades(self) -> DataFrame:
        """Trades with times cut to the hour, so that many share one."""
        return self.trades.withColumn("exchange_ts", F.date_trunc("hour", "exchange_ts"))

    @cached_property
    def levels(self) -> DataFrame:
        return self.spark.sql(_spark_sql(LEVELS), events=self.events)

    @cached_property
    def hourly_levels(self) -> DataFrame:
        """Book rows with times cut to the hour, so that snapshots of one token share a time."""
        return self.levels.withColumn("exchange_ts", F.date_trunc("hour", "exchange_ts"))

    @cached_property
    def raw_markets(self) -> DataFrame:
        return self.spark.sql(_spark_sql(MARKETS), part=self.read("part"))

    @cached_property
    def category_map(self) -> DataFrame:
        return self.spark.sql(_spark_sql(CATEGORY_MAP), customer=self.read("customer"))

    @cached_property
    def markets(self) -> DataFrame:
        return computed_category(self.raw_markets, self.category_map)

    @cached_property
    def trade_messages(self) -> DataFrame:
        """One feed message per event, in a different spelling for each event type."""
        return self._landed(TRADE_MESSAGES)

    @cached_property
    def book_messages(self) -> DataFrame:
        """One book message per event: twelve bids, up to twelve asks, unsorted, some of size 0."""
        return self._landed(BOOK_MESSAGES)

    def _landed(self, text: str) -> DataFrame:
        # The driver table is one file of one row group; a feed lands in many files.
        return self.spark.sql(text, trades=self.trades).repartition(self.spark.sparkContext.defaultParallelism)

    @cached_property
    def orders(self) -> DataFrame:
        """Line items read as unranked orders of one book per part."""
        return self.read("lineitem").selectExpr(
            "l_partkey AS snapshot",
            "CASE WHEN l_linestatus = 'O' THEN 'bid' ELSE 'ask' END AS side",
            "l_extendedprice AS price",
            "l_quantity AS size",
            "l_orderkey",
            "l_linenumber",
            "l_suppkey",
        )

    @cached_property
    def as_of(self) -> str:
        """The newest event: the query time of all look-backs."""
        return self.events.agg(F.max("ts").cast("string")).first()[0]

    def later(self, interval: str) -> str:
        """A time after the newest event."""
        return self.events.agg((F.max("ts") + F.expr(f"INTERVAL {interval}")).cast("string")).first()[0]
