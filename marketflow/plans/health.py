"""Health queries: freshness, token coverage, table statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions.aggregates import approx_distinct
from marketflow.functions.metrics import coverage, freshness as age_and_status, moment, month_key, rate
from marketflow.operators.dimension import latest_markets
from marketflow.operators.filters import lookback

# The look-back windows of the monitors.
WINDOWS = {"rows_30s": "30 SECONDS", "rows_2m": "2 MINUTES", "rows_5m": "5 MINUTES", "rows_1h": "1 HOUR"}


def freshness(trades: DataFrame, levels: DataFrame, as_of=None) -> DataFrame:
    """Rows per look-back window, newest row, its age and status, one row per table; each table is scanned once."""
    now = moment(as_of)

    def report(df: DataFrame, table: str) -> DataFrame:
        ts = F.col("exchange_ts")
        counts = [F.count_if(ts >= now - F.expr(f"INTERVAL {w}")).alias(name) for name, w in WINDOWS.items()]
        seconds, status = age_and_status(F.col("last_ts"), now)
        return df.agg(*counts, F.max(ts).alias("last_ts")).select(
            F.lit(table).alias("table"), "*", seconds.alias("age_seconds"), status.alias("status")
        )

    return report(trades, "trades_raw").unionByName(report(levels, "orderbook_levels"))


def flow_alarm(trades: DataFrame, levels: DataFrame, as_of=None, interval: str = "5 MINUTES", stale_seconds: int = 120) -> DataFrame:
    """One row: rows of the last minutes in both tables, the newest of them (a trade if there is one), its age, and the
    alarm: `no data`, `stopped` if it is older than `stale_seconds`, else `flowing`. Both scans read the interval only."""
    now = moment(as_of)

    def recent(df: DataFrame, table: str) -> DataFrame:
        rows = lookback(df, as_of, interval, inclusive=False)
        return rows.agg(F.count(F.lit(1)).alias(f"{table}_rows"), F.max("exchange_ts").alias(f"{table}_ts"))

    both = recent(trades, "trades").unionByName(recent(levels, "levels"), allowMissingColumns=True)
    row = both.agg(*[F.max(c).alias(c) for c in both.columns])
    last = F.coalesce("trades_ts", "levels_ts")
    age = (F.unix_millis(now) - F.unix_millis(last)) / F.lit(1000.0)
    alarm = F.when(last.isNull(), "no data").when(age > stale_seconds, "stopped").otherwise("flowing")
    return row.select("trades_rows", "levels_rows", last.alias("last_ts"), age.alias("age_seconds"), alarm.alias("alarm"))


def recent_tokens(trades: DataFrame, levels: DataFrame, as_of=None, interval: str = "1 HOUR") -> DataFrame:
    """Tokens seen in the last hour, with the table they were seen in."""
    parts = [
        lookback(df, as_of, interval, inclusive=False).select("token_id", F.lit(name).alias("seen_in"))
        for df, name in ((trades, "trades"), (levels, "levels"))
    ]
    return parts[0].unionByName(parts[1])


def token_coverage(
    trades: DataFrame, levels: DataFrame, markets: DataFrame, as_of=None, interval: str = "1 HOUR", exact: bool = True
) -> DataFrame:
    """Recently seen tokens against known tokens, in one row."""
    recent = recent_tokens(trades, levels, as_of, interval)
    traded, booked = F.col("seen_in") == "trades", F.col("seen_in") == "levels"
    names = ("trade_tokens", "book_tokens", "recent_tokens")
    if exact:
        # One row per token first: one combined aggregation instead of one distinct per count.
        per_token = recent.groupBy("token_id").agg(F.max(traded).alias("traded"), F.max(booked).alias("booked"))
        counts = (F.count_if("traded"), F.count_if("booked"), F.count(F.lit(1)))
    else:
        per_token, token = recent, F.col("token_id")
        counts = (approx_distinct(F.when(traded, token)), approx_distinct(F.when(booked, token)), approx_distinct(token))
    seen = per_token.agg(*[count.alias(name) for count, name in zip(counts, names)])
    known = latest_markets(markets).agg(
        F.count(F.lit(1)).alias("markets"),
        F.count_if(F.col("active") == 1).alias("active_markets"),
        F.sum(F.size("clob_token_ids")).alias("known_tokens"),
    )
    # Two one-row results, folded into one row.
    both = seen.unionByName(known, allowMissingColumns=True)
    row = both.agg(*[F.max(c).alias(c) for c in both.columns])
    pct, label = coverage(F.col("recent_tokens"), F.col("known_tokens"))
    return row.select("*", pct.alias("coverage_pct"), label.alias("coverage"))


def table_stats(df: DataFrame) -> DataFrame:
    """Rows, first and last time, rows per second."""
    stats = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("exchange_ts").alias("first_record"),
        F.max("exchange_ts").alias("last_record"),
    )
    speed = rate(F.col("total_rows"), F.col("first_record"), F.col("last_record"))
    return stats.select("*", speed.alias("rows_per_second"))


def month_stats(df: DataFrame, limit: int = 10) -> DataFrame:
    """Rows and time range of the newest month partitions."""
    stats = df.groupBy(month_key("exchange_ts").alias("month")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("exchange_ts").alias("first_record"),
        F.max("exchange_ts").alias("last_record"),
    )
    return stats.orderBy(F.desc("month")).limit(limit)
