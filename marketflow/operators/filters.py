"""Filters, sort and top-k helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions.metrics import moment, month_key


def optional_eq(df: DataFrame, col: str, value=None) -> DataFrame:
    return df if value is None else df.filter(F.col(col) == F.lit(value))


def for_token(df: DataFrame, market: str | None = None, token: str | None = None) -> DataFrame:
    return optional_eq(optional_eq(df, "condition_id", market), "token_id", token)


def _months(df: DataFrame, lo: Column | None, hi: Column | None) -> DataFrame:
    # Spark does not derive the partition predicate from the timestamp predicate, so it is added here.
    if "event_month" not in df.columns:
        return df
    if lo is not None:
        df = df.filter(F.col("event_month").cast("string") >= month_key(lo))
    if hi is not None:
        df = df.filter(F.col("event_month").cast("string") <= month_key(hi))
    return df


def between_ts(df: DataFrame, lo, hi, col: str = "exchange_ts") -> DataFrame:
    """Closed time range."""
    low, high = moment(lo), moment(hi)
    return _months(df, low, high).filter(F.col(col).between(low, high))


def lookback(df: DataFrame, as_of, interval: str, inclusive: bool = True, col: str = "exchange_ts") -> DataFrame:
    """Rows of the last `interval`, e.g. '24 HOURS', before `as_of`."""
    low = moment(as_of) - F.expr(f"INTERVAL {interval}")
    bound = F.col(col) >= low if inclusive else F.col(col) > low
    return _months(df, low, None).filter(bound)


def scoped(df: DataFrame, market: str | None = None, token: str | None = None, span: tuple | None = None) -> DataFrame:
    """The three dashboard selectors; what is not given does not restrict."""
    df = for_token(df, market, token)
    return df if span is None else between_ts(df, *span)


def at_level(df: DataFrame, n: int) -> DataFrame:
    return df.filter(F.col("level") == n)


def up_to_level(df: DataFrame, n: int) -> DataFrame:
    return df.filter(F.col("level") <= n)


def with_book(df: DataFrame, *cols: str) -> DataFrame:
    """Rows where every named column is present."""
    for col in cols:
        df = df.filter(F.col(col).isNotNull())
    return df


def of_side(df: DataFrame, side: str) -> DataFrame:
    return df.filter(F.col("side") == side)


def matches(df: DataFrame, col: str, text: str, case: bool = False) -> DataFrame:
    """Rows whose `col` contains `text`; `%` and `_` in the text keep their pattern meaning."""
    pattern = f"%{text}%"
    return df.filter(F.col(col).like(pattern) if case else F.col(col).ilike(pattern))


def non_empty(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) != "")


def active_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("active") == 1)


def in_series_order(df: DataFrame, market: str | None, ordered: bool | None, *columns: str) -> DataFrame:
    """The rows of one market in order; those of all markets only if `ordered` asks for it, as that sorts all rows."""
    return df.orderBy(*columns) if (market is not None if ordered is None else ordered) else df


def top(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    """The `k` greatest by one column; `ties` fix the order of equal rows."""
    return df.orderBy(F.desc(by), *ties).limit(k)
