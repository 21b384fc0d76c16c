"""Market queries."""

from checks.registry import AS_OF, HOURS, VALUE, add, half_even, rounded6
from marketflow.operators import dimension
from marketflow.plans import markets as q

SINCE = f"exchange_ts > {AS_OF} - INTERVAL {HOURS} HOUR"
FROM = f"exchange_ts >= {AS_OF} - INTERVAL {HOURS} HOUR"
RECENT = f"updated_at >= {AS_OF} - INTERVAL 1 DAY"
NEWEST = "max_by({0}, updated_at)"

add(
    "top_markets",
    lambda t: q.top_markets(t.trades, t.markets, t.as_of, hours=HOURS),
    f"""SELECT t.condition_id AS market_id, coalesce(any_value(m.question), '') AS question,
               coalesce(any_value(m.category), '') AS category,
               coalesce(any_value(m.computed_category), '') AS computed_category, count(*) AS trade_count,
               {half_even(f"sum({VALUE})", 2)} AS total_volume
        FROM trades t LEFT JOIN latest m ON t.condition_id = m.condition_id WHERE {SINCE}
        GROUP BY t.condition_id ORDER BY trade_count DESC, t.condition_id LIMIT 10""",
    "trades",
    "latest",
)
_CATEGORY = f"""
SELECT coalesce(m.computed_category, '') AS computed_category, count(DISTINCT t.condition_id) AS market_count,
       count(*) AS trade_count, {half_even(f"sum({VALUE})", 2)} AS total_volume
FROM trades t LEFT JOIN latest m ON t.condition_id = m.condition_id WHERE {SINCE}
GROUP BY coalesce(m.computed_category, '')"""
add("category_stats", lambda t: q.category_stats(t.trades, t.markets, t.as_of, hours=HOURS), _CATEGORY, "trades", "latest")
add(
    "category_share",
    lambda t: rounded6(q.category_share(t.trades, t.markets, t.as_of, hours=HOURS), "share_pct"),
    f"""SELECT computed_category, total_volume, round(total_volume * 100 / sum(total_volume) OVER (), 6) AS share_pct
        FROM ({_CATEGORY})""",
    "trades",
    "latest",
)

_ACTIVE = f"""
SELECT t.condition_id, m.question, m.computed_category AS category, count(*) AS trades,
       {half_even(f"sum({VALUE})", 2)} AS volume
FROM trades t JOIN latest m ON t.condition_id = m.condition_id {{where}}
GROUP BY t.condition_id, m.question, m.computed_category ORDER BY {{by}} DESC, t.condition_id LIMIT {{limit}}"""
add(
    "top_active_by_trades",
    lambda t: q.top_active(t.trades, t.markets, limit=15),
    _ACTIVE.format(where="", by="trades", limit=15),
    "trades",
    "latest",
)
add(
    "top_active_by_volume",
    lambda t: q.top_active(t.trades, t.markets, by="volume", limit=20),
    _ACTIVE.format(where="", by=f"sum({VALUE})", limit=20),
    "trades",
    "latest",
)
add(
    "top_active_in_category",
    lambda t: q.top_active(t.trades, t.markets, category="HOUSEHOLD", limit=15),
    _ACTIVE.format(where="WHERE m.computed_category = 'HOUSEHOLD'", by="trades", limit=15),
    "trades",
    "latest",
)
add(
    "top_reported_volume",
    lambda t: q.top_reported_volume(t.markets),
    f"""SELECT condition_id, {NEWEST.format("question")} AS market, {half_even("max(volume_total)", 2)} AS volume_total,
               max(updated_at) AS last_updated
        FROM markets WHERE active = 1 GROUP BY condition_id ORDER BY max(volume_total) DESC, condition_id LIMIT 50""",
    "markets",
)


def _named(columns: str, table: str, order: str, where: str = "") -> str:
    return f"""SELECT f.condition_id, coalesce(any_value(m.question), '') AS market, {columns}
               FROM {table} f LEFT JOIN latest m ON f.condition_id = m.condition_id WHERE {FROM} {where}
               GROUP BY f.condition_id ORDER BY {order} DESC, f.condition_id LIMIT 50"""


_BOOK = "count(*) AS orderbook_updates, max(exchange_ts) AS last_ob_ts"
_TRADED = f"""{half_even(f"sum({VALUE})", 2)} AS volume, count(*) AS trades, max(exchange_ts) AS last_trade_ts"""
add(
    "most_updated_books",
    lambda t: q.most_updated_books(t.levels, t.markets, t.as_of, hours=HOURS),
    _named(_BOOK, "levels", "orderbook_updates"),
    "levels",
    "latest",
)
add(
    "most_updated_books_in_category",
    lambda t: q.most_updated_books(t.levels, t.markets, t.as_of, hours=HOURS, category="MACHINERY"),
    _named(_BOOK, "levels", "orderbook_updates", "AND m.computed_category = 'MACHINERY'"),
    "levels",
    "latest",
)
add(
    "top_traded_volume",
    lambda t: q.top_traded_volume(t.trades, t.markets, t.as_of, hours=HOURS),
    _named(_TRADED, "trades", "volume"),
    "trades",
    "latest",
)
add(
    "list_categories",
    lambda t: q.list_categories(t.markets, t.as_of),
    f"SELECT DISTINCT computed_category FROM markets WHERE {RECENT}",
    "markets",
)
add(
    "list_active_categories",
    lambda t: q.list_categories(t.markets, active_only_rows=True),
    "SELECT DISTINCT computed_category FROM markets WHERE active = 1",
    "markets",
)
add(
    "list_events",
    lambda t: q.list_events(t.markets, t.as_of),
    f"""SELECT event_id, max_by(event_title, struct_pack(u := updated_at, t := event_title)) AS event_title,
               max(updated_at) AS updated_at
        FROM markets WHERE {RECENT} AND event_id <> '' GROUP BY event_id ORDER BY max(updated_at) DESC, event_id
        LIMIT 20000""",
    "markets",
)
_LIST = f"""SELECT condition_id, {NEWEST.format("question")} AS question, max(updated_at) AS updated_at
            FROM markets WHERE {{where}} GROUP BY condition_id ORDER BY {{order}}, condition_id LIMIT {{limit}}"""
add(
    "list_markets_by_title",
    lambda t: q.list_markets(t.markets, t.as_of),
    _LIST.format(where=RECENT, order="question", limit=50000),
    "markets",
)
add(
    "list_markets_newest",
    lambda t: q.list_markets(t.markets, t.as_of, order="newest"),
    _LIST.format(where=f"{RECENT} AND len(clob_token_ids) > 0", order="max(updated_at) DESC", limit=50000),
    "markets",
)
add(
    "list_active_markets_like",
    lambda t: q.list_markets(t.markets, like="ring", active=True, order="newest", limit=100),
    _LIST.format(
        where="active = 1 AND len(clob_token_ids) > 0 AND question LIKE '%ring%'", order="max(updated_at) DESC", limit=100
    ),
    "markets",
)
add(
    "list_markets_by_activity",
    lambda t: q.list_markets_by_activity(t.trades, t.markets),
    """SELECT t.condition_id, m.question, m.computed_category, count(*) AS trades
       FROM trades t JOIN latest m ON t.condition_id = m.condition_id GROUP BY ALL
       ORDER BY trades DESC, t.condition_id LIMIT 30""",
    "trades",
    "latest",
)
add(
    "list_tokens",
    lambda t: q.list_tokens(t.markets),
    "SELECT condition_id, unnest(clob_token_ids) AS token_id FROM latest",
    "latest",
)
add("list_book_tokens", lambda t: q.list_book_tokens(t.levels), "SELECT DISTINCT token_id FROM levels", "levels")
_COUNTS = """
SELECT h.*, coalesce(trade_count, 0) AS trade_count, first_trade, last_trade, coalesce(level_count, 0) AS level_count
FROM hits h
LEFT JOIN (SELECT condition_id, count(*) AS trade_count, min(exchange_ts) AS first_trade, max(exchange_ts) AS last_trade
           FROM trades GROUP BY ALL) USING (condition_id)
LEFT JOIN (SELECT condition_id, count(*) AS level_count FROM levels GROUP BY ALL) USING (condition_id)"""
add(
    "search_markets",
    lambda t: q.search_markets(t.markets, t.trades, t.levels, "HOT"),
    """, hits AS (SELECT market_id, condition_id, question, category, computed_category FROM latest
                  WHERE question ILIKE '%HOT%' ORDER BY question, market_id LIMIT 20)"""
    + _COUNTS,
    "latest",
    "trades",
    "levels",
)
for _name, _text in (("search_markets_indexed", "HOT"), ("search_markets_indexed_pattern", "RED wi_get%r2")):
    add(
        _name,
        lambda t, text=_text: q.search_markets(t.markets, t.trades, t.levels, text, index=q.search_index(t.markets)),
        f""", hits AS (SELECT market_id, condition_id, question, category, computed_category FROM latest
                      WHERE question ILIKE '%{_text}%' ORDER BY question, market_id LIMIT 20)"""
        + _COUNTS,
        "latest",
        "trades",
        "levels",
    )
add(
    "first_markets",
    lambda t: q.first_markets(t.markets),
    "SELECT market_id, condition_id, question, category FROM latest ORDER BY question, market_id LIMIT 20",
    "latest",
)
_EVENTS = """
SELECT event_id, max_by(event_title, struct_pack(u := updated_at, t := event_title)) AS event_title,
       count(DISTINCT market_id) AS market_count
FROM markets WHERE event_id <> '' GROUP BY event_id HAVING count(DISTINCT market_id) >= 2 {having}
ORDER BY market_count DESC, event_id LIMIT 20"""
add("multi_market_events", lambda t: q.multi_market_events(t.markets), _EVENTS.format(having=""), "markets")
add(
    "multi_market_events_keyword",
    lambda t: q.multi_market_events(t.markets, "Gizmo"),
    _EVENTS.format(having="AND count(*) FILTER (WHERE event_title ILIKE '%Gizmo%' OR question ILIKE '%Gizmo%') > 0"),
    "markets",
)
add(
    "event_markets",
    lambda t: q.event_markets(t.markets),
    "SELECT event_id, market_id, question, computed_category, active, closed FROM latest WHERE event_id <> ''",
    "latest",
)

# The dimension itself.
add(
    "latest_markets",
    lambda t: dimension.latest_markets(t.markets).drop("clob_token_ids"),
    "SELECT * EXCLUDE (clob_token_ids, rn) FROM latest",
    "latest",
)
add(
    "computed_category",
    lambda t: t.markets.select("market_id", "updated_at", "computed_category"),
    "SELECT market_id, updated_at, computed_category FROM markets",
    "markets",
)
add(
    "token_map",
    lambda t: dimension.token_map(t.markets),
    "SELECT unnest(clob_token_ids) AS token_id, condition_id, market_id FROM latest",
    "latest",
)
add(
    "tokens_for_category",
    lambda t: dimension.tokens_for_category(t.markets),
    """SELECT computed_category, condition_id, market_id, unnest(clob_token_ids) AS token_id FROM latest
       WHERE len(clob_token_ids) > 0""",
    "latest",
)
add(
    "new_tokens",
    lambda t: dimension.new_tokens(t.levels, q.list_tokens(t.markets)),
    """SELECT DISTINCT token_id FROM levels
       WHERE token_id NOT IN (SELECT unnest(clob_token_ids) FROM latest)""",
    "levels",
    "latest",
)
add(
    "enriched_trades",
    # The feed names the market by its condition, as the live messages do.
    lambda t: dimension.enrich(
        t.trades.selectExpr("trade_id", "token_id", "'' AS condition_id", "condition_id AS market_id"),
        dimension.token_map(t.markets),
    ),
    """SELECT t.trade_id, t.token_id, coalesce(m.condition_id, '') AS condition_id,
              coalesce(m.market_id, t.condition_id) AS market_id
       FROM trades t LEFT JOIN (SELECT unnest(clob_token_ids) AS token_id, condition_id, market_id FROM latest) m
         ON t.token_id = m.token_id""",
    "trades",
    "latest",
)
