"""Scalar formulas over trades and book levels."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketflow.functions.aggregates import rounded


def moment(as_of) -> Column:
    """Query time: None for now, a datetime (UTC if naive), a string in the session time zone, or a column."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime):
        return F.lit(as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc))
    return F.lit(as_of).cast("timestamp")


def notional(price: Column, size: Column) -> Column:
    return price * size


def signed_notional(side: Column, price: Column, size: Column) -> Column:
    """Buys count up, every other side counts down."""
    return F.when(side == "BUY", price * size).otherwise(-(price * size))


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2


def spread(bid: Column, ask: Column) -> Column:
    return ask - bid


def liquidity(bid_sz: Column, ask_sz: Column) -> Column:
    return bid_sz + ask_sz


def imbalance(bid_sz: Column, ask_sz: Column) -> Column:
    both = bid_sz + ask_sz
    return F.when(both > 0, (bid_sz - ask_sz).cast("double") / both.cast("double")).otherwise(0.0)


def latency_ms(exchange: Column, local: Column) -> Column:
    return (F.unix_millis(local) - F.unix_millis(exchange)).cast("float")


def probability(mid_px: Column, yes: bool = True) -> Column:
    """Implied probability in percent."""
    p = mid_px if yes else 1 - mid_px
    return rounded(p * 100, 2)


# Chart labels of the first level; deeper levels append their number.
LABELS = {
    "bid": ("YES Bid Lvl1", "YES Bid Lvl2", "YES Bid Lvl3"),
    "ask": ("YES Ask Lvl1", "YES Ask Lvl2", "YES Ask Lvl3"),
    "bid_size": ("YES Bid Size Lvl1", "YES Bid Size Lvl2", "YES Bid Size Lvl3"),
    "ask_size": ("YES Ask Size Lvl1", "YES Ask Size Lvl2", "YES Ask Size Lvl3"),
    "mid": ("YES Mid Price", "YES Mid Price Lvl2", "YES Mid Price Lvl3"),
    "imbalance": ("YES Imbalance", "YES Imbalance Lvl2", "YES Imbalance Lvl3"),
    "spread": ("Spread (Lvl1)", "Spread (Lvl2)", "Spread (Lvl3)"),
    "liquidity": ("YES Total Liquidity", "YES Total Liquidity Lvl2", "YES Total Liquidity Lvl3"),
}


def level_label(level: Column, metric: str) -> Column:
    """Label of levels 1 to 3, null below."""
    label = F.lit(None).cast("string")
    for n, text in reversed(list(enumerate(LABELS[metric], start=1))):
        label = F.when(level == n, F.lit(text)).otherwise(label)
    return label


def pressure(x: Column, cut: float = 0.3) -> Column:
    return F.when(x > cut, "BUY").when(x < -cut, "SELL").otherwise("NEUTRAL")


def level_text(level: Column) -> Column:
    return level.cast("string")


def thousands(x: Column) -> Column:
    return x / 1000


def bucket(ts: Column | str, every: str) -> Column:
    """Start of the epoch-aligned interval, e.g. `bucket("exchange_ts", "5 seconds")`."""
    return F.window(ts, every)["start"]


def minute_of(ts: Column | str) -> Column:
    return F.date_trunc("minute", ts)


def hour_of(ts: Column | str) -> Column:
    return F.date_trunc("hour", ts)


def month_key(ts: Column | str) -> Column:
    """UTC month as yyyyMM, taken from the epoch so that the session time zone does not matter."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    day = F.date_from_unix_date(F.floor(F.unix_seconds(ts.cast("timestamp")) / 86400).cast("int"))
    return F.lpad((F.year(day) * 100 + F.month(day)).cast("string"), 6, "0")


def rate(count: Column, first: Column, last: Column) -> Column:
    """Rows per second over a closed interval of whole seconds."""
    return count.cast("double") / (F.unix_seconds(last) - F.unix_seconds(first) + 1)


def array_len(col: Column) -> Column:
    return F.size(col)


def array_at(col: Column, position: int) -> Column:
    """Element at a 1-based position; null when out of range (position 0 never matches)."""
    if position == 0:
        return F.lit(None)
    return F.try_element_at(col, F.lit(position))


def readable_bytes(n: Column) -> Column:
    """1536 → '1.50 KB'."""
    size = n.cast("double")
    text = F.format_string("%.2f PB", size / float(1024**5))
    for power, unit in reversed(list(enumerate(("B", "KB", "MB", "GB", "TB")))):
        scaled = size / float(1024**power)
        text = F.when(scaled < 1024, F.format_string(f"%.2f {unit}", scaled)).otherwise(text)
    return text


def freshness(last: Column, as_of: Column) -> tuple[Column, Column]:
    """Age of the newest row in seconds, and its status."""
    seconds = (F.unix_millis(as_of) - F.unix_millis(last)) / F.lit(1000.0)
    status = (
        F.when(last.isNull(), "NO DATA").when(seconds < 60, "ACTIVE").when(seconds < 300, "SLOW").otherwise("STOPPED")
    )
    return seconds, status


def coverage(recent: Column, known: Column) -> tuple[Column, Column]:
    """Share of the known tokens that were seen, in percent, and its label."""
    pct = F.when(known > 0, recent.cast("double") / known * 100).otherwise(0.0)
    return pct, F.when(pct > 50, "good").when(pct > 10, "medium").otherwise("low")
