"""Order-book queries."""

from checks.registry import AS_OF, HOURS, TOK, add, half_even, mean, rounded6
from marketflow.functions.metrics import LABELS
from marketflow.operators.book import bbo_1s
from marketflow.plans import book as q

PX = "bid_px IS NOT NULL AND ask_px IS NOT NULL"
SZ = "bid_sz IS NOT NULL AND ask_sz IS NOT NULL"
MID = "(CAST(bid_px + ask_px AS DOUBLE) / 2)"
SPREAD = "(ask_px - bid_px)"
LIQUIDITY = "(bid_sz + ask_sz)"
IMBALANCE = """(CASE WHEN bid_sz + ask_sz > 0
                THEN CAST(bid_sz - ask_sz AS DOUBLE) / CAST(bid_sz + ask_sz AS DOUBLE) ELSE 0 END)"""


def _label(metric: str) -> str:
    cases = " ".join(f"WHEN level = {n} THEN '{text}'" for n, text in enumerate(LABELS[metric], start=1))
    return f"CASE {cases} END"


def _double(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


_STATE = "bid_px, bid_sz, ask_px, ask_sz"
_BBO = f"""
SELECT ts_bucket, market_id, {TOK}, CAST(bid_px AS DOUBLE) AS bid_px, CAST(bid_sz AS DOUBLE) AS bid_sz,
       CAST(ask_px AS DOUBLE) AS ask_px, CAST(ask_sz AS DOUBLE) AS ask_sz, CAST(ask_px - bid_px AS DOUBLE) AS spread,
       {MID} AS mid_px
FROM (SELECT *, date_trunc('second', exchange_ts) AS ts_bucket,
             row_number() OVER (PARTITION BY market_id, {TOK}, date_trunc('second', exchange_ts)
                                ORDER BY exchange_ts DESC) AS rn
      FROM levels WHERE level = 1) WHERE rn = 1"""
add("bbo_1s", lambda t: bbo_1s(t.levels), _BBO, "levels")
add(
    "bbo_lookback",
    lambda t: q.bbo_df(t.levels, t.as_of, hours=HOURS),
    f"SELECT * FROM ({_BBO}) WHERE ts_bucket > {AS_OF} - INTERVAL {HOURS} HOUR",
    "levels",
)
add(
    "price_levels",
    lambda t: q.price_levels(t.levels),
    f"SELECT {TOK}, exchange_ts, level, {_double('bid_px', 'bid_px')}, {_double('ask_px', 'ask_px')} FROM levels",
    "levels",
)
add(
    "size_levels",
    lambda t: q.size_levels(t.levels),
    f"SELECT {TOK}, exchange_ts, level, {_double('bid_sz', 'bid_sz')}, {_double('ask_sz', 'ask_sz')} FROM levels",
    "levels",
)
for _what, _bid, _ask, _labels in (
    ("price", "bid_px", "ask_px", ("bid", "ask")),
    ("size", "bid_sz", "ask_sz", ("bid_size", "ask_size")),
):
    add(
        f"labelled_{_what}_levels",
        lambda t, what=_what: q.labelled_levels(t.levels, what),
        f"""SELECT {TOK}, exchange_ts, {_label(_labels[0])} AS series, {_double(_bid, "value")} FROM levels
            WHERE level <= 3 AND {_bid} IS NOT NULL
            UNION ALL SELECT {TOK}, exchange_ts, {_label(_labels[1])}, CAST({_ask} AS DOUBLE) FROM levels
            WHERE level <= 3 AND {_ask} IS NOT NULL""",
        "levels",
    )


def _side(side: str, col: str, label: str, stats: str) -> str:
    return f"""SELECT {TOK}, level, '{side}' AS side, {_label(label)} AS name,
                      CAST(max_by({col}, exchange_ts) AS DOUBLE) AS last, {stats.replace("?", col)}
               FROM levels WHERE {col} IS NOT NULL GROUP BY {TOK}, level"""


_PRICE_STATS = (
    f"{half_even(mean('?'), 4)} AS mean, CAST(max(?) AS DOUBLE) AS \"max\", CAST(min(?) AS DOUBLE) AS \"min\""
)
_SIZE_STATS = f"{half_even(mean('?'), 2)} AS mean, {half_even('sum(?)', 0)} AS total"
add(
    "price_summary",
    lambda t: q.price_summary(t.levels),
    _side("bid", "bid_px", "bid", _PRICE_STATS) + " UNION ALL " + _side("ask", "ask_px", "ask", _PRICE_STATS),
    "levels",
)
add(
    "size_summary",
    lambda t: q.size_summary(t.levels),
    _side("bid", "bid_sz", "bid_size", _SIZE_STATS) + " UNION ALL " + _side("ask", "ask_sz", "ask_size", _SIZE_STATS),
    "levels",
)
for _name, _expr, _present, _run in (
    ("mid", MID, PX, q.mid_series),
    ("imbalance", IMBALANCE, SZ, q.imbalance_series),
    ("spread", SPREAD, PX, q.spread_series),
    ("liquidity", LIQUIDITY, SZ, q.liquidity_series),
):
    add(
        f"{_name}_series",
        lambda t, run=_run: run(t.levels),
        f"SELECT {TOK}, exchange_ts, level, {_double(_expr, _name)} FROM levels WHERE {_present}",
        "levels",
    )
_LAST = "CAST(max_by({0}, exchange_ts) AS DOUBLE)"
for _name, _run, _present, _stats in (
    (
        "mid",
        q.mid_summary,
        PX,
        # Twice the mid, as a decimal, keeps the sums and differences exact.
        f"""{_LAST.format(MID)} AS last, {half_even("CAST(sum(bid_px + ask_px) AS DOUBLE) / 2 / count(*)", 4)} AS mean,
            {half_even("CAST(max_by(bid_px + ask_px, exchange_ts) - min(bid_px + ask_px) AS DOUBLE) / 2", 4)} AS delta""",
    ),
    (
        "imbalance",
        q.imbalance_summary,
        SZ,
        f"""{_LAST.format(IMBALANCE)} AS last, {half_even(f"avg({IMBALANCE})", 4)} AS mean,
            max({IMBALANCE}) AS "max", min({IMBALANCE}) AS "min" """,
    ),
    (
        "spread",
        q.spread_summary,
        PX,
        f"""{_LAST.format(SPREAD)} AS last, {half_even(mean(SPREAD), 4)} AS mean, CAST(max({SPREAD}) AS DOUBLE) AS "max" """,
    ),
    (
        "liquidity",
        q.liquidity_summary,
        SZ,
        f"""{_LAST.format(LIQUIDITY)} AS last, {half_even(mean(LIQUIDITY), 0)} AS mean,
            CAST(min({LIQUIDITY}) AS DOUBLE) AS "min" """,
    ),
):
    add(
        f"{_name}_summary",
        lambda t, run=_run: run(t.levels),
        f"SELECT {TOK}, level, {_label(_name)} AS name, {_stats} FROM levels WHERE {_present} GROUP BY {TOK}, level",
        "levels",
    )
add(
    "probability_series",
    lambda t: q.probability_series(t.levels),
    f"""SELECT {TOK}, exchange_ts, 'YES Probability' AS series, {MID} AS value FROM levels WHERE level = 1 AND {PX}
        UNION ALL SELECT {TOK}, exchange_ts, 'NO Probability', 1 - {MID} FROM levels WHERE level = 1 AND {PX}""",
    "levels",
)
_TWICE = "CAST(max_by(bid_px + ask_px, exchange_ts) AS DOUBLE)"
add(
    "current_probability",
    lambda t: q.current_probability(t.levels),
    f"""SELECT {TOK}, 'YES Probability' AS name, {half_even(f"{_TWICE} * 50", 2)} AS value
        FROM levels WHERE level = 1 AND {PX} GROUP BY {TOK}
        UNION ALL SELECT {TOK}, 'NO Probability', {half_even(f"100 - {_TWICE} * 50", 2)}
        FROM levels WHERE level = 1 AND {PX} GROUP BY {TOK}""",
    "levels",
)
add(
    "market_pressure",
    lambda t: rounded6(q.market_pressure(t.levels), "avg_imbalance"),
    f"""SELECT {TOK}, round(v, 6) AS avg_imbalance,
               CASE WHEN v > 0.3 THEN 'BUY' WHEN v < -0.3 THEN 'SELL' ELSE 'NEUTRAL' END AS pressure
        FROM (SELECT {TOK}, avg({IMBALANCE}) AS v FROM levels WHERE level = 1 AND {SZ} GROUP BY {TOK})""",
    "levels",
)
add(
    "unified_yes_axis",
    lambda t: q.unified_yes_axis(t.levels, t.markets),
    f"""SELECT l.condition_id, l.token_id, exchange_ts, level,
               CASE WHEN l.token_id = m.clob_token_ids[1] THEN {MID} WHEN l.token_id = m.clob_token_ids[2] THEN 1 - {MID} END
                 AS yes_probability
        FROM levels l LEFT JOIN latest m ON l.condition_id = m.condition_id WHERE level = 1 AND {PX}""",
    "levels",
    "latest",
)
add(
    "ask_depth",
    lambda t: q.ask_depth(t.levels),
    f""", touch AS (SELECT {TOK}, exchange_ts, CAST(ask_px AS DOUBLE) AS touch_price FROM levels
                    WHERE level = 1 AND ask_px IS NOT NULL)
        SELECT {TOK}, exchange_ts, CAST(sum(ask_sz) AS DOUBLE) / 1000 AS ask_depth
        FROM levels JOIN touch USING (condition_id, token_id, exchange_ts)
        WHERE ask_px IS NOT NULL AND CAST(ask_px AS DOUBLE) <= touch_price + CAST(0.10 AS DOUBLE)
          AND CAST(ask_px AS DOUBLE) >= touch_price
        GROUP BY {TOK}, exchange_ts""",
    "levels",
)
add(
    "ask_depth_shared_snapshots",
    lambda t: q.ask_depth(t.hourly_levels),
    f""", shared AS (SELECT * REPLACE (date_trunc('hour', exchange_ts) AS exchange_ts) FROM levels),
        touch AS (SELECT {TOK}, exchange_ts, CAST(ask_px AS DOUBLE) AS touch_price FROM shared
                  WHERE level = 1 AND ask_px IS NOT NULL)
        SELECT {TOK}, exchange_ts, CAST(sum(ask_sz) AS DOUBLE) / 1000 AS ask_depth
        FROM shared JOIN touch USING (condition_id, token_id, exchange_ts)
        WHERE ask_px IS NOT NULL AND CAST(ask_px AS DOUBLE) <= touch_price + CAST(0.10 AS DOUBLE)
          AND CAST(ask_px AS DOUBLE) >= touch_price
        GROUP BY {TOK}, exchange_ts""",
    "levels",
)
add(
    "depth_points",
    lambda t: q.depth_points(t.levels),
    f"""SELECT {TOK}, date_trunc('minute', exchange_ts) AS time, CAST(level AS VARCHAR) AS level,
               {_double(LIQUIDITY, "liquidity")} FROM levels WHERE level <= 10 AND {SZ}""",
    "levels",
)
add(
    "depth_heatmap",
    lambda t: q.depth_heatmap(t.levels),
    f"""SELECT {TOK}, date_trunc('minute', exchange_ts) AS time, CAST(level AS VARCHAR) AS level,
               {_double(f"sum({LIQUIDITY})", "liquidity")} FROM levels WHERE level <= 10 AND {SZ} GROUP BY ALL""",
    "levels",
)
add(
    "book_updates_per_minute",
    lambda t: q.book_updates_per_minute(t.levels),
    """SELECT date_trunc('minute', exchange_ts) AS time, count(*) AS orderbook_updates FROM levels WHERE level = 1
       GROUP BY ALL""",
    "levels",
)
add(
    "quote_series",
    lambda t: q.quote_series(t.levels),
    f"""SELECT {TOK}, exchange_ts, level, {_double("bid_px", "bid_px")}, {_double("ask_px", "ask_px")} FROM levels
        WHERE level = 1 AND bid_px IS NOT NULL""",
    "levels",
)
add(
    "level_stats",
    lambda t: q.level_stats(t.levels),
    f"""SELECT {TOK}, count(*) AS total, max(level) AS max_level, count(DISTINCT level) AS unique_levels FROM levels
        GROUP BY {TOK}""",
    "levels",
)
