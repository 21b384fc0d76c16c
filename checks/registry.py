"""Where queries and their check SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.tables import Tables, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

AS_OF = "(SELECT max(ts) FROM events)"
TOK = "condition_id, token_id"
VALUE = "price * size"
SIGNED = "CASE WHEN side = 'BUY' THEN price * size ELSE -(price * size) END"
BUY = "coalesce(CAST(sum(price * size) FILTER (WHERE side = 'BUY') AS DOUBLE), 0)"
SELL = "coalesce(CAST(sum(price * size) FILTER (WHERE side = 'SELL') AS DOUBLE), 0)"
# Look-back of the registered queries: the whole month of the driver tables.
HOURS = 720


def half_even(expr: str, digits: int) -> str:
    """SQL that rounds to `digits` places with halves to even, exactly, through integers of 1e-9."""
    unit = f"CAST(CAST({expr} AS DECIMAL(28,9)) * CAST(1000000000 AS DECIMAL(10,0)) AS HUGEINT)"
    step = 10 ** (9 - digits)
    whole, rest = f"(abs({unit}) // {step})", f"(abs({unit}) % {step})"
    up = f"CASE WHEN 2 * {rest} > {step} OR (2 * {rest} = {step} AND {whole} % 2 = 1) THEN 1 ELSE 0 END"
    return f"(sign({unit}) * CAST({whole} + {up} AS DOUBLE) / CAST({10**digits} AS DOUBLE) + 0)"


def mean(expr: str) -> str:
    return f"(CAST(sum({expr}) AS DOUBLE) / count({expr}))"


def plain(df: DataFrame) -> DataFrame:
    """Result types both engines share: zone-less timestamps, doubles for decimals, ints for shorts."""
    shared = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.ShortType):
            c = c.cast("int")
        shared.append(c.alias(f.name))
    return df.select(*shared)


def rounded6(df: DataFrame, *cols: str) -> DataFrame:
    """Six places for values that are sums of doubles, whose last digits depend on the order of addition."""
    return df.withColumns({c: F.round(c, 6) for c in cols})


def add(name: str, run: Callable[[Tables], DataFrame], sql: str | None = None, *tables: str) -> None:
    """Register a query and the SQL over `tables` that must give the same rows."""
    QUERIES[name] = lambda spark, sf_dir: plain(run(Tables(spark, sf_dir)))
    if sql is not None:
        SQL[name] = with_tables(sql, *tables) if tables else sql
