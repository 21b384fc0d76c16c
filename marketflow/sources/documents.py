"""Landed metadata documents (JSON lines or arrays) → flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow import schemas


def _string_list(col: str) -> Column:
    """An array of strings that arrives as an array or as its JSON text."""
    return F.coalesce(F.from_json(col, "array<string>"), F.array().cast("array<string>"))


def _iso_time(col: Column | str) -> Column:
    """ISO date or date-time, null when it is not one; a time or a year alone is none."""
    text = F.col(col) if isinstance(col, str) else col
    return F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def _flag(col: str) -> Column:
    """1 for a value that is present, not false, not zero and not empty."""
    return F.when(F.coalesce(F.lower(col), F.lit("")).isin("", "false", "0", "0.0"), 0).otherwise(1).cast("short")


def _amount(col: str) -> Column:
    return F.coalesce(F.expr(f"try_cast({col} AS DOUBLE)"), F.lit(0.0))


def _labels(tags: Column) -> Column:
    labels = F.filter(F.transform(tags, lambda t: t["label"]), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.coalesce(labels, F.array().cast("array<string>"))


def transform_markets(raw: DataFrame) -> DataFrame:
    """Market documents → market rows; of several events the first one counts."""
    event = F.get(F.from_json("events", schemas.EVENT_REF), F.lit(0))
    first = raw.withColumn("_e", event)
    return first.select(
        F.col("id").alias("market_id"),
        F.coalesce("conditionId", F.lit("")).alias("condition_id"),
        F.coalesce("_e.id", F.lit("")).alias("event_id"),
        F.coalesce("_e.slug", F.lit("")).alias("event_slug"),
        F.coalesce("_e.title", F.lit("")).alias("event_title"),
        _iso_time("_e.startDate").alias("event_start_date"),
        _iso_time("_e.endDate").alias("event_end_date"),
        _labels(F.col("_e.tags")).alias("event_tags"),
        F.coalesce("question", F.lit("")).alias("question"),
        F.coalesce("slug", F.lit("")).alias("slug"),
        F.coalesce("category", F.lit("Unknown")).alias("category"),
        _string_list("outcomes").alias("outcomes"),
        _string_list("clobTokenIds").alias("clob_token_ids"),
        _iso_time("endDate").alias("end_date"),
        _flag("active").alias("active"),
        _flag("closed").alias("closed"),
        _amount("volumeNum").alias("volume_total"),
        _amount("liquidityNum").alias("liquidity"),
        _amount("bestBid").alias("best_bid"),
        _amount("bestAsk").alias("best_ask"),
        _amount("lastTradePrice").alias("last_trade_price"),
    )


def transform_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.coalesce("id", F.lit("")).alias("event_id"),
        F.coalesce("slug", F.lit("")).alias("event_slug"),
        F.coalesce("title", F.lit("")).alias("event_title"),
        _iso_time("startDate").alias("event_start_date"),
        _iso_time("endDate").alias("event_end_date"),
        _labels(F.col("tags")).alias("event_tags"),
        F.coalesce("markets", F.array().cast("array<string>")).alias("markets"),
    )


def transform_rest_trades(raw: DataFrame) -> DataFrame:
    """Historic trade documents; market_id stays '' until the rows are joined to the token map."""
    micros = F.round(F.col("timestamp") * 1_000_000).cast("long")
    return raw.select(
        F.timestamp_micros(micros).alias("exchange_ts"),
        F.lit("").alias("market_id"),
        F.coalesce("conditionId", F.lit("")).alias("condition_id"),
        F.coalesce("asset", F.lit("")).alias("token_id"),
        F.coalesce("side", F.lit("UNKNOWN")).alias("side"),
        _amount("price").alias("price"),
        _amount("size").alias("size"),
        F.coalesce("outcome", F.lit("")).alias("outcome"),
        F.coalesce("outcomeIndex", F.lit(0)).cast("short").alias("outcome_index"),
        F.coalesce("transactionHash", F.lit("")).alias("trade_id"),
        F.lit(None).cast("string").alias("maker_address"),
        F.coalesce("proxyWallet", F.lit("")).alias("taker_address"),
        F.lit("data_api").alias("source"),
    )


def transform_rest_books(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Book documents → best bid and offer with sizes; of equal best prices the first entry counts."""

    def entries(side: str, sign: int) -> Column:
        def keyed(e: Column, i: Column) -> Column:
            px, sz = (F.coalesce(e[f].try_cast("double"), F.lit(0.0)) for f in ("price", "size"))
            return F.struct((px * sign).alias("k"), i.alias("i"), px.alias("px"), sz.alias("sz"))

        return F.array_min(F.transform(side, keyed))

    best = raw.withColumns({"_bid": entries("bids", -1), "_ask": entries("asks", 1)})
    market = F.coalesce("market", F.lit(""))
    return best.select(
        (now if now is not None else F.current_timestamp()).alias("exchange_ts"),
        market.alias("market_id"),
        market.alias("condition_id"),
        F.coalesce("asset_id", F.lit("")).alias("token_id"),
        F.col("_bid.px").alias("bid_px"),
        F.col("_bid.sz").alias("bid_sz"),
        F.col("_ask.px").alias("ask_px"),
        F.col("_ask.sz").alias("ask_sz"),
        _amount("last_trade_price").alias("last_trade_price"),
        F.lit("clob_rest").alias("source"),
    )


def _parsed(spark: SparkSession, path: str, schema: str, pages: bool) -> DataFrame:
    """(file, value, found): every line, or with `pages` every file, with its documents; null if it is no JSON."""
    texts = spark.read.text(path, wholetext=pages).withColumn("file", F.input_file_name()).filter(F.trim("value") != "")
    return texts.withColumn("found", F.from_json("value", T.ArrayType(T.StructType.fromDDL(schema))))


def _readable(spark: SparkSession, path: str, schema: str, pages: bool) -> DataFrame:
    return _parsed(spark, path, schema, pages).select(F.inline("found"))


def read_rejected(spark: SparkSession, path: str, schema: str, pages: bool = False) -> DataFrame:
    """(file, text) of what the readers below leave out: lines, or with `pages` whole files, that are no document."""
    return _parsed(spark, path, schema, pages).filter(F.col("found").isNull()).select("file", F.col("value").alias("text"))


def read_markets(spark: SparkSession, path: str, pages: bool = False) -> DataFrame:
    """Documents by line, or with `pages` one JSON page (object or array) per file."""
    return transform_markets(_readable(spark, path, schemas.MARKET_DOC, pages))


def read_events(spark: SparkSession, path: str, pages: bool = False) -> DataFrame:
    return transform_events(_readable(spark, path, schemas.EVENT_DOC, pages))


def read_rest_trades(spark: SparkSession, path: str, pages: bool = False) -> DataFrame:
    return transform_rest_trades(_readable(spark, path, schemas.TRADE_DOC, pages))


def read_rest_books(spark: SparkSession, path: str, pages: bool = False) -> DataFrame:
    return transform_rest_books(_readable(spark, path, schemas.BOOK_DOC, pages))
