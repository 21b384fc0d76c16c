"""Queries over partial rows per minute, against the same SQL as the queries over all trades.

Trades are rolled up once per event type, as if each had come in a batch of its own, so every minute and token has
several partial rows to merge.
"""

from pyspark.sql import functions as F

from checks.registry import AS_OF, BUY, SELL, TOK, VALUE, add
from marketflow.operators import rollups as q
from marketflow.operators.filters import lookback


def _minutes(t):
    return q.trade_minutes(t.trades, "event_type")


for _name, _every, _keys in (("bucket_volume_5m_rollup", "5 minutes", TOK), ("bucket_volume_1h_rollup_by_market", "60 minutes", "condition_id")):
    add(
        _name,
        lambda t, every=_every, keys=_keys: q.bucket_volume(_minutes(t), every, by_token=keys == TOK),
        f"""SELECT {_keys}, time_bucket(INTERVAL '{_every}', exchange_ts) AS time, {BUY} AS buy_volume,
                   {SELL} AS sell_volume FROM trades GROUP BY ALL""",
        "trades",
    )
add(
    "bucket_total_rollup",
    lambda t: q.bucket_total(_minutes(t), "10 minutes"),
    f"""SELECT {TOK}, time_bucket(INTERVAL '10 minutes', exchange_ts) AS time, CAST(sum({VALUE}) AS DOUBLE) AS volume
        FROM trades GROUP BY ALL""",
    "trades",
)
add(
    "trades_per_minute_rollup",
    lambda t: q.trades_per_minute(_minutes(t)),
    "SELECT date_trunc('minute', exchange_ts) AS time, count(*) AS trades FROM trades GROUP BY ALL",
    "trades",
)
add(
    "hourly_volume_rollup",
    lambda t: q.hourly_volume(_minutes(t)),
    f"""SELECT condition_id, date_trunc('hour', exchange_ts) AS hour, CAST(sum({VALUE}) AS DOUBLE) AS volume
        FROM trades GROUP BY ALL""",
    "trades",
)
add(
    "market_totals_rollup",
    lambda t: q.market_totals(_minutes(t)),
    f"""SELECT condition_id, count(*) AS total_trades, CAST(sum({VALUE}) AS DOUBLE) AS total_volume,
               CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price,
               CAST(sum(size) AS DOUBLE) / count(*) AS avg_trade_size, {BUY} AS buy_volume, {SELL} AS sell_volume,
               min(exchange_ts) AS first_trade, max(exchange_ts) AS last_trade
        FROM trades GROUP BY condition_id""",
    "trades",
)


def _sketched(t):
    """Counts from united sketches, held against the exact ones: the bound is 2 %."""
    hours, exact = "240 HOURS", []
    sketches = None
    for name, df in (("trades", t.trades), ("levels", t.levels)):
        rows = lookback(df.withColumn("exchange_ts", F.date_trunc("minute", "exchange_ts")), t.as_of, hours)
        part = q.minute_sketches(rows, name)
        sketches = part if sketches is None else sketches.unionByName(part)
        exact.append(rows.select(F.lit(name).alias("seen_in"), "token_id", "condition_id"))
    found = q.distinct_seen(sketches).withColumn("seen_in", F.coalesce("seen_in", F.lit("all")))
    both = exact[0].unionByName(exact[1])
    counts = both.unionByName(both.withColumn("seen_in", F.lit("all"))).groupBy("seen_in")
    known = counts.agg(F.countDistinct("token_id").alias("token_count"), F.countDistinct("condition_id").alias("market_count"))
    near = [(F.abs(F.col(c) - F.col(n)) <= 0.02 * F.col(n)).alias(f"{c}_near") for c, n in (("tokens", "token_count"), ("markets", "market_count"))]
    return found.join(known, "seen_in").select("seen_in", "rows", "token_count", "market_count", *near)


_RECENT = f"date_trunc('minute', exchange_ts) >= {AS_OF} - INTERVAL 240 HOUR"
add(
    "distinct_seen_sketch",
    _sketched,
    f"""SELECT seen_in, count(*) AS rows, count(DISTINCT token_id) AS token_count,
               count(DISTINCT condition_id) AS market_count, TRUE AS tokens_near, TRUE AS markets_near
        FROM (SELECT unnest([seen_in, 'all']) AS seen_in, {TOK}
              FROM (SELECT 'trades' AS seen_in, {TOK} FROM trades WHERE {_RECENT}
                    UNION ALL SELECT 'levels', {TOK} FROM levels WHERE {_RECENT})) GROUP BY seen_in""",
    "trades",
    "levels",
)
