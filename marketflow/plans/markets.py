"""Queries over the market dimension, alone or joined to trades and levels.

Facts are aggregated per condition before they meet the dimension, so that a market with a third of the
trades costs the join one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marketflow.functions.aggregates import rounded
from marketflow.functions.metrics import notional
from marketflow.operators.dimension import latest, latest_by_condition, with_market
from marketflow.operators.filters import active_only, lookback, matches, non_empty, optional_eq, scoped, top
from marketflow.operators.search import find, postings
from marketflow.session import pinned

MOST_HITS = 10_000  # of a search: its hits are broadcast


def _value() -> Column:
    return notional(F.col("price"), F.col("size"))


def _per_condition(trades: DataFrame) -> DataFrame:
    return trades.groupBy("condition_id").agg(F.count(F.lit(1)).alias("trades"), F.sum(_value()).alias("volume"))


def _named(best: DataFrame, markets: DataFrame, columns: list[str]) -> DataFrame:
    """Name the rows of a top-k result. It is small by its limit: it is found once, and only its markets' versions are read on."""
    best = pinned(best)
    wanted = markets.join(F.broadcast(best.select("condition_id")), "condition_id", "left_semi")
    return with_market(best, wanted, columns, "left")


def top_markets(trades: DataFrame, markets: DataFrame, as_of=None, hours: int = 24, limit: int = 10) -> DataFrame:
    """Markets by trade count."""
    counts = _per_condition(lookback(trades, as_of, f"{hours} HOURS", inclusive=False))
    # The limit needs only the trades, so the join sees `limit` rows.
    best = top(counts, "trades", limit, "condition_id")
    named = _named(best, markets, ["question", "category", "computed_category"])
    out = named.select(
        F.col("condition_id").alias("market_id"),
        "question",
        "category",
        "computed_category",
        F.col("trades").alias("trade_count"),
        rounded(F.col("volume"), 2).alias("total_volume"),
    )
    return out.orderBy(F.desc("trade_count"), "market_id")


def category_stats(trades: DataFrame, markets: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    """Markets, trades and volume per category; trades of unknown markets form the '' group."""
    counts = _per_condition(lookback(trades, as_of, f"{hours} HOURS", inclusive=False))
    named = with_market(counts, markets, ["computed_category"], "left")
    out = named.groupBy("computed_category").agg(
        F.count(F.lit(1)).alias("market_count"),
        F.sum("trades").alias("trade_count"),
        rounded(F.sum("volume"), 2).alias("total_volume"),
    )
    return out.orderBy(F.desc("total_volume"), "computed_category")


def category_share(trades: DataFrame, markets: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    """Each category's part of the volume in percent."""
    stats = category_stats(trades, markets, as_of, hours)
    # One row per category, so one window over all of them is small.
    whole = F.sum("total_volume").over(W.partitionBy(F.lit(1)))
    return stats.select("computed_category", "total_volume", (F.col("total_volume") * 100 / whole).alias("share_pct"))


def top_active(
    trades: DataFrame,
    markets: DataFrame,
    category: str | None = None,
    by: str = "trades",
    limit: int = 15,
    span: tuple | None = None,
) -> DataFrame:
    """Known markets by trade count ('trades') or by volume ('volume')."""
    named = with_market(_per_condition(scoped(trades, span=span)), markets, ["question", "computed_category"])
    best = top(optional_eq(named, "computed_category", category), by, limit, "condition_id")
    return best.select(
        "condition_id",
        "question",
        F.col("computed_category").alias("category"),
        "trades",
        rounded(F.col("volume"), 2).alias("volume"),
    )


def top_reported_volume(markets: DataFrame, category: str | None = None, limit: int = 50) -> DataFrame:
    """Active markets by the greatest volume any version reports."""
    rows = optional_eq(active_only(markets), "computed_category", category)
    out = rows.groupBy("condition_id").agg(
        F.max(F.struct("updated_at", "question")).alias("_newest"),
        rounded(F.max("volume_total"), 2).alias("volume_total"),
        F.max("updated_at").alias("last_updated"),
    )
    named = out.select("condition_id", F.col("_newest.question").alias("market"), "volume_total", "last_updated")
    return top(named, "volume_total", limit, "condition_id")


def most_updated_books(
    levels: DataFrame, markets: DataFrame, as_of=None, hours: int = 24, category: str | None = None, limit: int = 50
) -> DataFrame:
    """Markets by number of book rows."""
    counts = (
        lookback(levels, as_of, f"{hours} HOURS")
        .groupBy("condition_id")
        .agg(F.count(F.lit(1)).alias("orderbook_updates"), F.max("exchange_ts").alias("last_ob_ts"))
    )
    return _named_top(counts, markets, category, "orderbook_updates", limit)


def top_traded_volume(
    trades: DataFrame, markets: DataFrame, as_of=None, hours: int = 24, category: str | None = None, limit: int = 50
) -> DataFrame:
    """Markets by traded volume."""
    counts = (
        lookback(trades, as_of, f"{hours} HOURS")
        .groupBy("condition_id")
        .agg(
            rounded(F.sum(_value()), 2).alias("volume"),
            F.count(F.lit(1)).alias("trades"),
            F.max("exchange_ts").alias("last_trade_ts"),
        )
    )
    return _named_top(counts, markets, category, "volume", limit)


def _named_top(counts: DataFrame, markets: DataFrame, category: str | None, by: str, limit: int) -> DataFrame:
    if category is None:
        # No condition on the dimension: cut first, then name the rows that are left.
        named = _named(top(counts, by, limit, "condition_id"), markets, ["question"])
        named = named.orderBy(F.desc(by), "condition_id")
    else:
        named = with_market(counts, markets, ["question", "computed_category"], "left")
        named = top(optional_eq(named, "computed_category", category), by, limit, "condition_id")
    return named.drop("computed_category").withColumnRenamed("question", "market")


def _recent(markets: DataFrame, as_of) -> DataFrame:
    return lookback(markets, as_of, "1 DAY", col="updated_at")


def list_categories(markets: DataFrame, as_of=None, active_only_rows: bool = False) -> DataFrame:
    """Categories updated in the last day, or those of active markets."""
    rows = active_only(markets) if active_only_rows else _recent(markets, as_of)
    return rows.select("computed_category").distinct().orderBy("computed_category")


def list_events(markets: DataFrame, as_of=None, category: str | None = None, limit: int = 20_000) -> DataFrame:
    """Events updated in the last day with their newest title, newest first."""
    rows = optional_eq(non_empty(_recent(markets, as_of), "event_id"), "computed_category", category)
    events = latest(rows, ["event_id"], ["event_title", "updated_at"])
    return top(events, "updated_at", limit, "event_id")


def list_markets(
    markets: DataFrame,
    as_of=None,
    category: str | None = None,
    event: str | None = None,
    like: str | None = None,
    active: bool = False,
    order: str = "title",
    limit: int = 50_000,
) -> DataFrame:
    """Markets with their newest question, by title or newest first; `like` is a case-sensitive substring.

    With `active`, all versions count; otherwise those of the last day. Newest first also asks for tokens.
    """
    rows = active_only(markets) if active else _recent(markets, as_of)
    rows = optional_eq(optional_eq(rows, "computed_category", category), "event_id", event)
    if like is not None:
        rows = matches(rows, "question", like, case=True)
    if order == "newest":
        rows = rows.filter(F.size("clob_token_ids") > 0)
    found = latest(rows, ["condition_id"], ["question", "updated_at"])
    if order == "newest":
        return top(found, "updated_at", limit, "condition_id")
    return found.orderBy("question", "condition_id").limit(limit)


def list_markets_by_activity(
    trades: DataFrame, markets: DataFrame, category: str | None = None, limit: int = 30
) -> DataFrame:
    """Known markets by number of trades over all time."""
    counts = trades.groupBy("condition_id").agg(F.count(F.lit(1)).alias("trades"))
    named = with_market(counts, markets, ["question", "computed_category"])
    return top(optional_eq(named, "computed_category", category), "trades", limit, "condition_id")


def list_tokens(markets: DataFrame, market: str | None = None) -> DataFrame:
    """Tokens of each market's newest version."""
    newest = latest_by_condition(optional_eq(markets, "condition_id", market), "clob_token_ids")
    return newest.select("condition_id", F.explode("clob_token_ids").alias("token_id"))


def list_book_tokens(levels: DataFrame, as_of=None, market: str | None = None, interval: str | None = None) -> DataFrame:
    """Tokens that have book rows, of a market or recent."""
    rows = optional_eq(levels, "condition_id", market)
    rows = rows if interval is None else lookback(rows, as_of, interval, inclusive=False)
    return rows.select("token_id").distinct().orderBy("token_id")


def _newest_by_market(markets: DataFrame, *columns: str) -> DataFrame:
    return latest(markets, ["market_id"], list(columns))


def search_index(markets: DataFrame) -> DataFrame:
    """Search index of the questions of the newest versions, for `search_markets`."""
    return postings(_newest_by_market(markets, "question").filter(F.col("market_id").isNotNull()), ["market_id"], "question")


def search_markets(
    markets: DataFrame, trades: DataFrame, levels: DataFrame, text: str, limit: int = 20, index: DataFrame | None = None
) -> DataFrame:
    """Markets whose question contains `text` (any case), with trade count, first and last trade, book rows.

    The hits are at most `limit` rows: they are found once, and broadcast to cut both fact tables before these
    are counted. With `index`, the questions to compare come from the intersected lists of the search index.
    """
    if not 0 <= limit <= MOST_HITS:
        raise ValueError(f"limit must be from 0 to {MOST_HITS}")
    newest = _newest_by_market(markets, "condition_id", "question", "category", "computed_category")
    if index is None:
        found = matches(newest, "question", text)
    else:
        found = find(newest.filter(F.col("market_id").isNotNull()), index, ["market_id"], "question", text)
    hits = pinned(found.orderBy("question", "market_id").limit(limit))
    wanted = F.broadcast(hits.select("condition_id").distinct())
    traded = (
        trades.join(wanted, "condition_id", "left_semi")
        .groupBy("condition_id")
        .agg(
            F.count(F.lit(1)).alias("trade_count"),
            F.min("exchange_ts").alias("first_trade"),
            F.max("exchange_ts").alias("last_trade"),
        )
    )
    booked = (
        levels.join(wanted, "condition_id", "left_semi")
        .groupBy("condition_id")
        .agg(F.count(F.lit(1)).alias("level_count"))
    )
    out = hits.join(traded, "condition_id", "left").join(booked, "condition_id", "left")
    return out.fillna(0, ["trade_count", "level_count"]).orderBy("question", "market_id")


def first_markets(markets: DataFrame, limit: int = 20) -> DataFrame:
    """The fallback listing of a search without hits: the first markets by question."""
    newest = _newest_by_market(markets, "condition_id", "question", "category")
    return newest.orderBy("question", "market_id").limit(limit)


def multi_market_events(markets: DataFrame, keyword: str | None = None, limit: int = 20) -> DataFrame:
    """Events with at least two markets, optionally with a keyword in their title or a question."""
    rows = non_empty(markets, "event_id")
    word = F.lit(True)
    if keyword is not None:
        pattern = f"%{keyword}%"
        word = F.col("event_title").ilike(pattern) | F.col("question").ilike(pattern)
    # First one row per (event, market): distinct markets without collecting an event's rows.
    per_market = rows.groupBy("event_id", "market_id").agg(
        F.max(F.struct("updated_at", "event_title")).alias("_newest"), F.count_if(word).alias("_hits")
    )
    events = per_market.groupBy("event_id").agg(
        F.max("_newest").alias("_newest"), F.count(F.lit(1)).alias("market_count"), F.sum("_hits").alias("_hits")
    )
    found = events.filter((F.col("market_count") >= 2) & (F.col("_hits") > 0))
    out = found.select("event_id", F.col("_newest.event_title").alias("event_title"), "market_count")
    return top(out, "market_count", limit, "event_id")


def event_markets(markets: DataFrame, event: str | None = None) -> DataFrame:
    """Markets of an event with their newest attributes."""
    rows = optional_eq(non_empty(markets, "event_id"), "event_id", event)
    out = latest(rows, ["event_id", "market_id"], ["question", "computed_category", "active", "closed"])
    return out.orderBy("event_id", "question", "market_id")

