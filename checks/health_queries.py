"""Health queries."""

from checks.registry import AS_OF, add
from marketflow.plans import health as q

# Written out, so that a change of the code under test shows.
WINDOWS = {"rows_30s": "30 SECONDS", "rows_2m": "2 MINUTES", "rows_5m": "5 MINUTES", "rows_1h": "1 HOUR"}


def _fresh(table: str, name: str) -> str:
    counts = ", ".join(
        f"count(*) FILTER (WHERE exchange_ts >= {AS_OF} - INTERVAL '{window}') AS {column}"
        for column, window in WINDOWS.items()
    )
    return f"""
SELECT '{name}' AS "table", *,
       (epoch_ms({AS_OF}) - epoch_ms(last_ts)) / CAST(1000 AS DOUBLE) AS age_seconds,
       CASE WHEN last_ts IS NULL THEN 'NO DATA' WHEN epoch_ms({AS_OF}) - epoch_ms(last_ts) < 60000 THEN 'ACTIVE'
            WHEN epoch_ms({AS_OF}) - epoch_ms(last_ts) < 300000 THEN 'SLOW' ELSE 'STOPPED' END AS status
FROM (SELECT {counts}, max(exchange_ts) AS last_ts FROM {table})"""


add(
    "freshness",
    lambda t: q.freshness(t.trades, t.levels, t.as_of),
    _fresh("trades", "trades_raw") + " UNION ALL " + _fresh("levels", "orderbook_levels"),
    "trades",
    "levels",
)
_HOUR = f"exchange_ts > {AS_OF} - INTERVAL 1 HOUR"
add(
    "token_coverage",
    lambda t: q.token_coverage(t.trades, t.levels, t.markets, t.as_of),
    f"""SELECT *, CAST(recent_tokens AS DOUBLE) / known_tokens * 100 AS coverage_pct,
               CASE WHEN CAST(recent_tokens AS DOUBLE) / known_tokens * 100 > 50 THEN 'good'
                    WHEN CAST(recent_tokens AS DOUBLE) / known_tokens * 100 > 10 THEN 'medium' ELSE 'low' END AS coverage
        FROM (SELECT (SELECT count(DISTINCT token_id) FROM trades WHERE {_HOUR}) AS trade_tokens,
                     (SELECT count(DISTINCT token_id) FROM levels WHERE {_HOUR}) AS book_tokens,
                     (SELECT count(DISTINCT token_id) FROM (SELECT token_id FROM trades WHERE {_HOUR}
                        UNION ALL SELECT token_id FROM levels WHERE {_HOUR})) AS recent_tokens,
                     (SELECT count(*) FROM latest) AS markets,
                     (SELECT count(*) FROM latest WHERE active = 1) AS active_markets,
                     (SELECT CAST(sum(len(clob_token_ids)) AS BIGINT) FROM latest) AS known_tokens)""",
    "trades",
    "levels",
    "latest",
)
for _table in ("trades", "levels"):
    add(
        f"{_table}_table_stats",
        lambda t, table=_table: q.table_stats(getattr(t, table)),
        f"""SELECT count(*) AS total_rows, min(exchange_ts) AS first_record, max(exchange_ts) AS last_record,
                   CAST(count(*) AS DOUBLE) / (CAST(floor(epoch(max(exchange_ts))) AS BIGINT)
                     - CAST(floor(epoch(min(exchange_ts))) AS BIGINT) + 1) AS rows_per_second FROM {_table}""",
        _table,
    )
    add(
        f"{_table}_month_stats",
        lambda t, table=_table: q.month_stats(getattr(t, table)),
        f"""SELECT strftime(exchange_ts, '%Y%m') AS month, count(*) AS total_rows, min(exchange_ts) AS first_record,
                   max(exchange_ts) AS last_record FROM {_table} GROUP BY month ORDER BY month DESC LIMIT 10""",
        _table,
    )


def _alarm(moment: str, minutes: int) -> str:
    since = f"exchange_ts > {moment} - INTERVAL {minutes} MINUTE"
    return f"""
SELECT *, (epoch_ms({moment}) - epoch_ms(last_ts)) / CAST(1000 AS DOUBLE) AS age_seconds,
       CASE WHEN last_ts IS NULL THEN 'no data' WHEN epoch_ms({moment}) - epoch_ms(last_ts) > 120000 THEN 'stopped'
            ELSE 'flowing' END AS alarm
FROM (SELECT (SELECT count(*) FROM trades WHERE {since}) AS trades_rows,
             (SELECT count(*) FROM levels WHERE {since}) AS levels_rows,
             coalesce((SELECT max(exchange_ts) FROM trades WHERE {since}),
                      (SELECT max(exchange_ts) FROM levels WHERE {since})) AS last_ts)"""


# As of the newest event, as of ten minutes after it (stale within an hour), and as of a week after it (no data).
for _name, _as_of, _minutes in (("", AS_OF, 5), ("_stopped", f"({AS_OF} + INTERVAL 10 MINUTE)", 60), ("_no_data", f"({AS_OF} + INTERVAL 7 DAY)", 5)):
    add(
        f"flow_alarm{_name}",
        lambda t, name=_name, minutes=_minutes: q.flow_alarm(
            t.trades, t.levels, t.later({"": "0 MINUTES", "_stopped": "10 MINUTES", "_no_data": "7 DAYS"}[name]), f"{minutes} MINUTES"
        ),
        _alarm(_as_of, _minutes),
        "trades",
        "levels",
    )
