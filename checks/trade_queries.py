"""Trade queries."""

from checks.registry import AS_OF, BUY, HOURS, SELL, SIGNED, TOK, VALUE, add, half_even, mean, rounded6
from marketflow.plans import trades as q

SINCE = f"exchange_ts > {AS_OF} - INTERVAL {HOURS} HOUR"

add(
    "trades_lookback",
    lambda t: q.trades_df(t.trades, t.as_of, hours=HOURS),
    f"""SELECT exchange_ts, market_id, {TOK}, CAST(price AS DOUBLE) AS price, CAST(size AS DOUBLE) AS size,
               CAST({VALUE} AS DOUBLE) AS notional, side, trade_id FROM trades WHERE {SINCE}""",
    "trades",
)
add(
    "market_profile",
    lambda t: rounded6(q.market_profile(t.trades, t.as_of, hours=HOURS), "price_std"),
    f"""SELECT condition_id, count(*) AS total_trades, CAST(sum({VALUE}) AS DOUBLE) AS total_volume,
               {mean("price")} AS avg_price, CAST(min(price) AS DOUBLE) AS min_price,
               CAST(max(price) AS DOUBLE) AS max_price, round(stddev_samp(CAST(price AS DOUBLE)), 6) AS price_std,
               {mean("size")} AS avg_trade_size, {BUY} AS buy_volume, {SELL} AS sell_volume,
               min(exchange_ts) AS first_trade, max(exchange_ts) AS last_trade
        FROM trades WHERE {SINCE} GROUP BY condition_id""",
    "trades",
)
add(
    "hourly_volume",
    lambda t: q.hourly_volume(t.trades, t.as_of, hours=HOURS),
    f"""SELECT condition_id, date_trunc('hour', exchange_ts) AS hour, CAST(sum({VALUE}) AS DOUBLE) AS volume
        FROM trades WHERE {SINCE} GROUP BY ALL""",
    "trades",
)
for _name, _every, _keys in (
    ("bucket_volume_5s", "5 seconds", TOK),
    ("bucket_volume_5m", "5 minutes", TOK),
    ("bucket_volume_5m_by_market", "5 minutes", "condition_id"),
):
    add(
        _name,
        lambda t, every=_every, keys=_keys: q.bucket_volume(t.trades, every, by_token=keys == TOK),
        f"""SELECT {_keys}, time_bucket(INTERVAL '{_every}', exchange_ts) AS time, {BUY} AS buy_volume,
                   {SELL} AS sell_volume FROM trades GROUP BY ALL""",
        "trades",
    )
add(
    "bucket_total_60s",
    lambda t: q.bucket_total(t.trades),
    f"""SELECT {TOK}, time_bucket(INTERVAL '60 seconds', exchange_ts) AS time, CAST(sum({VALUE}) AS DOUBLE) AS volume
        FROM trades GROUP BY ALL""",
    "trades",
)


def _running(value: str, keys: str, order: str = "exchange_ts", frame: str = "RANGE") -> str:
    return (
        f"CAST(sum({value}) OVER (PARTITION BY {keys} ORDER BY {order} "
        f"{frame} BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)"
    )


add(
    "cumulative_volume",
    lambda t: q.cumulative_volume(t.trades),
    f"SELECT {TOK}, exchange_ts, {_running(VALUE, TOK)} AS cum_volume FROM trades",
    "trades",
)
add(
    "cumulative_volume_by_market",
    lambda t: q.cumulative_volume(t.trades, by_token=False),
    f"SELECT condition_id, exchange_ts, {_running(VALUE, 'condition_id')} AS cum_volume FROM trades",
    "trades",
)
add(
    "cumulative_volume_with_ties",
    lambda t: q.cumulative_volume(t.tied_trades),
    f"""SELECT {TOK}, exchange_ts, {_running(VALUE, TOK)} AS cum_volume
        FROM (SELECT * REPLACE (date_trunc('hour', exchange_ts) AS exchange_ts) FROM trades)""",
    "trades",
)
add(
    "cumulative_delta",
    lambda t: q.cumulative_delta(t.trades),
    f"SELECT {TOK}, exchange_ts, {_running(SIGNED, TOK)} AS cum_delta FROM trades",
    "trades",
)
add(
    "cumulative_volume_and_delta",
    lambda t: q.cumulative_delta(t.tied_trades, with_volume=True),
    f"""SELECT {TOK}, exchange_ts, {_running(VALUE, TOK)} AS cum_volume, {_running(SIGNED, TOK)} AS cum_delta
        FROM (SELECT * REPLACE (date_trunc('hour', exchange_ts) AS exchange_ts) FROM trades)""",
    "trades",
)
add(
    "cumulative_rows",
    lambda t: q.cumulative_rows(t.trades),
    f"""SELECT condition_id, exchange_ts, trade_id, CAST({VALUE} AS DOUBLE) AS notional,
               {_running(VALUE, 'condition_id', 'exchange_ts, trade_id', 'ROWS')} AS cum_volume FROM trades""",
    "trades",
)
add(
    "top_takers",
    lambda t: q.top_takers(t.trades),
    f"""SELECT taker_address, count(*) AS trade_count, {half_even(f"sum({VALUE})", 2)} AS total_volume,
               {half_even(mean("price"), 4)} AS avg_price, {BUY} AS buy_volume, {SELL} AS sell_volume,
               {half_even(mean("delta_t_ms"), 2)} AS avg_latency_ms
        FROM trades WHERE taker_address <> '' GROUP BY taker_address
        ORDER BY sum({VALUE}) DESC, taker_address LIMIT 20""",
    "trades",
)
add(
    "latency_per_minute",
    lambda t: q.latency_per_minute(t.trades),
    f"""SELECT condition_id, date_trunc('minute', exchange_ts) AS time, {mean("delta_t_ms")} AS avg_latency_ms,
               max(delta_t_ms) AS max_latency_ms FROM trades GROUP BY ALL""",
    "trades",
)
add(
    "latency_overall",
    lambda t: q.latency_overall(t.trades),
    f"""SELECT condition_id, count(*) AS total, {mean("delta_t_ms")} AS avg_latency, max(delta_t_ms) AS max_latency,
               min(delta_t_ms) AS min_latency FROM trades WHERE delta_t_ms IS NOT NULL GROUP BY ALL""",
    "trades",
)
add(
    "latency_points",
    lambda t: q.latency_points(t.trades),
    f"""SELECT {TOK}, date_trunc('minute', exchange_ts) AS time, delta_t_ms AS value FROM trades
        WHERE delta_t_ms IS NOT NULL""",
    "trades",
)
add(
    "latency_heatmap",
    lambda t: q.latency_heatmap(t.trades),
    f"""SELECT {TOK}, date_trunc('minute', exchange_ts) AS time,
               CAST(floor(CAST(delta_t_ms AS DOUBLE) / 50) * 50 AS DOUBLE) AS latency_bin, count(*) AS trades
        FROM trades GROUP BY ALL""",
    "trades",
)
add(
    "trades_per_minute",
    lambda t: q.trades_per_minute(t.trades),
    "SELECT date_trunc('minute', exchange_ts) AS time, count(*) AS trades FROM trades GROUP BY ALL",
    "trades",
)
add(
    "price_series",
    lambda t: q.price_series(t.trades),
    f"SELECT {TOK}, exchange_ts, CAST(price AS DOUBLE) AS price, trade_id FROM trades",
    "trades",
)
add(
    "price_series_first_points",
    lambda t: q.price_series(t.trades, limit=500),
    f"""SELECT {TOK}, exchange_ts, CAST(price AS DOUBLE) AS price, trade_id FROM trades
        ORDER BY exchange_ts, trade_id LIMIT 500""",
    "trades",
)
add(
    "taker_stats",
    lambda t: q.taker_stats(t.trades),
    """SELECT condition_id, count(DISTINCT taker_address) AS unique_takers, count(*) AS trades_with_taker
       FROM trades WHERE taker_address <> '' GROUP BY condition_id""",
    "trades",
)
add(
    "busiest_token",
    lambda t: q.busiest_token(t.trades, t.as_of, hours=HOURS),
    f"""SELECT {TOK}, count(*) AS trade_count FROM trades WHERE exchange_ts >= {AS_OF} - INTERVAL {HOURS} HOUR
        GROUP BY ALL ORDER BY trade_count DESC, condition_id, token_id LIMIT 1""",
    "trades",
)
for _col in ("price", "size"):
    add(
        f"{_col}_histogram",
        lambda t, col=_col: q.price_histogram(t.trades, col),
        f"""SELECT condition_id, CAST(least(floor((x - lo) * 50 / (hi - lo)), 49) AS INT) AS bin, lo, hi, count(*) AS n
            FROM (SELECT condition_id, CAST({_col} AS DOUBLE) AS x FROM trades)
            JOIN (SELECT condition_id, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                         CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi
                  FROM (SELECT condition_id, CAST({_col} AS DOUBLE) AS v FROM trades) GROUP BY ALL) b USING (condition_id)
            GROUP BY ALL""",
        "trades",
    )
_SERIES = f"""
SELECT {TOK}, exchange_ts, 'ASK' AS series, CAST(ask_px AS DOUBLE) AS value FROM quotes WHERE ask_px IS NOT NULL
UNION ALL SELECT {TOK}, exchange_ts, 'BID', CAST(bid_px AS DOUBLE) FROM quotes WHERE bid_px IS NOT NULL
UNION ALL SELECT {TOK}, exchange_ts, 'Bid Hit', CAST(price AS DOUBLE) FROM trades WHERE side = 'SELL'
UNION ALL SELECT {TOK}, exchange_ts, 'Quote Lifted', CAST(price AS DOUBLE) FROM trades WHERE side = 'BUY'"""
add(
    "trades_and_bbo",
    lambda t: q.trades_and_bbo(t.trades, t.levels),
    ", quotes AS (SELECT * FROM levels WHERE level = 1)" + _SERIES,
    "trades",
    "levels",
)
add(
    "trades_and_bbo_both_quoted",
    lambda t: q.trades_and_bbo(t.trades, t.levels, both_quoted=True),
    ", quotes AS (SELECT * FROM levels WHERE level = 1 AND ask_px IS NOT NULL AND bid_px IS NOT NULL)" + _SERIES,
    "trades",
    "levels",
)
