"""Feed events → trade rows and book-level rows.

An event comes with its known fields as variants (`f`), null where the key is missing, and as texts (`t`). The feed treats a value
as absent when it is missing, null, '', 0 or false, but keeps the string '0'; variants keep numbers and
strings apart, so the same rule holds here. Events that cannot be read (a price that is no number, a time out
of range) are set apart by `reject` instead of stopping the events that came in the same message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marketflow.schemas import SIDES

DEPTH = 10

# Event types.
TRADE_TYPES = ("trade", "last_trade_price", "TRADE", "trade_executed", "execution")
BOOK_TYPES = ("book", "BOOK")

# Fixed value: first millisecond of the year 10000.
_MAX_MS = 253402300800000


def _v(key: str) -> Column:
    return F.col(f"f.{key}")


def _t(key: str) -> Column:
    return F.col(f"t.{key}")


def _present(text: Column, variant: Column) -> Column:
    """Not missing, null, '', false or the number 0. The type is looked up only where the text reads as zero or false."""
    zero = (F.translate(text, "-0.", "") == "") | (text == "false")
    return (F.coalesce(text, F.lit("")) != "") & (~zero | (F.schema_of_variant(variant) == "STRING"))


def _truthy(key: str) -> Column:
    return _present(_t(key), _v(key))


def has(key: str) -> Column:
    """Whether the event has the key, whatever its value (a null counts)."""
    return _v(key).isNotNull()


def event_type() -> Column:
    """`event_type`, or `type` when that is absent, empty or zero."""
    return F.when(_truthy("event_type"), _t("event_type")).when(_truthy("type"), _t("type"))


def classify(events: DataFrame) -> DataFrame:
    """Add event_type and kind: 'trade', 'book', or null for events that nothing handles."""
    typed = events.withColumn("event_type", event_type())
    quoted = has("bids") | has("asks")
    looks_traded = has("price") & has("size") & has("side") & ~quoted
    return typed.withColumn(
        "kind",
        F.when(F.col("event_type").isin(*TRADE_TYPES) | looks_traded, "trade").when(
            F.col("event_type").isin(*BOOK_TYPES) | quoted, "book"
        ),
    )


def _with_event_time(events: DataFrame, accept_digit_strings: bool) -> DataFrame:
    """Add exchange_ts: epoch milliseconds from `timestamp` or `ts`, else the receipt time.

    A `timestamp` that is zero or empty gives way to `ts`, and `ts` is taken as it is. Trades also accept a
    string of digits, books do not. A number that is no valid time gives null.
    """
    first = _truthy("timestamp")
    stamped = events.withColumns(
        {
            "_kind": F.schema_of_variant(F.when(first, _v("timestamp")).otherwise(_v("ts"))),
            "_ms": F.when(first, _t("timestamp")).otherwise(_t("ts")),
        }
    )
    micros = F.round(F.col("_ms").try_cast("decimal(30,6)") * 1000)
    valid = F.timestamp_micros(F.when(F.abs(micros) < _MAX_MS * 1000, micros).try_cast("long"))
    timed = F.col("_kind").isin("BIGINT", "DOUBLE", "FLOAT") | F.col("_kind").startswith("DECIMAL")
    if accept_digit_strings:
        timed = timed | ((F.col("_kind") == "STRING") & F.col("_ms").rlike("^[0-9]+$"))
    exchange_ts = F.when(timed, valid).otherwise(F.col("receipt_ts"))
    return stamped.withColumn("exchange_ts", exchange_ts).drop("_kind", "_ms")


def _first_key(*keys: str, default: str = "") -> Column:
    """Text of the first key that the event has; null values stay null."""
    found = F.lit(default)
    for key in reversed(keys):
        found = F.when(has(key), _t(key)).otherwise(found)
    return found


def _amount(key: str) -> Column:
    """Number of a key, 0 when the key is missing, null when it is no number. Java's trailing d and f are no part of one."""
    number = F.when(~F.lower(F.right(_t(key), F.lit(1))).isin("d", "f"), _t(key).try_cast("double"))
    return F.when(has(key), number).otherwise(F.lit(0.0))


def normalize_trades(trades: DataFrame) -> DataFrame:
    """Trade events → trade rows; `reject` says why a row cannot be stored, null if it can."""
    rows = _with_event_time(trades, accept_digit_strings=True).select(
        "exchange_ts",
        F.col("receipt_ts").alias("local_ts"),
        _first_key("market", "condition_id").alias("market_id"),
        _first_key("condition_id", "market").alias("condition_id"),
        F.coalesce(_first_key("asset_id", "asset"), F.lit("")).alias("token_id"),
        _first_key("side", default="UNKNOWN").alias("side"),
        _amount("price").alias("price"),
        _amount("size").alias("size"),
        _first_key("outcome").alias("outcome"),
        F.when(has("outcome_index"), _t("outcome_index").try_cast("short")).otherwise(F.lit(0)).cast("short").alias("outcome_index"),
        _first_key("id", "trade_id").alias("trade_id"),
        _first_key("maker").alias("maker_address"),
        _first_key("taker").alias("taker_address"),
        F.lit("websocket").alias("source"),
        "event",
    )
    reject = (
        F.when(F.col("exchange_ts").isNull(), "time out of range")
        .when(F.col("price").isNull() | F.col("size").isNull(), "price or size is not a number")
        .when(F.col("side").isNull() | ~F.col("side").isin(*SIDES), "unknown side")
        .when(~F.coalesce(F.col("outcome_index").between(0, 255), F.lit(False)), "outcome_index is no number from 0 to 255")
    )
    return rows.withColumn("reject", reject)


def check_side(trades: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose side is BUY, SELL or UNKNOWN, the others)."""
    good = F.coalesce(F.col("side").isin(*SIDES), F.lit(False))
    return trades.filter(good), trades.filter(~good)


def side_entries(key: str) -> Column:
    """One book side as an array of (n: numbers, v: variants); null if it is no array of objects."""
    variants = F.try_variant_get(_v(key), "$", "array<struct<price:variant,size:variant>>")
    numbers = F.try_variant_get(_v(key), "$", "array<struct<price:double,size:double>>")
    empty = F.array().cast("array<struct<n:struct<price:double,size:double>,v:struct<price:variant,size:variant>>>")
    return F.when(~has(key), empty).otherwise(F.arrays_zip(numbers.alias("n"), variants.alias("v")))


def parse_side(entries: Column) -> Column:
    """Prices and sizes; entries without a price or a size are left out.

    An unreadable number stays null and `reject`s the book. The variants are looked at only where the number
    is zero or null.
    """

    def present(e: Column, field: str) -> Column:
        variant = e["v"][field]
        return F.coalesce(e["n"][field] != 0, F.lit(False)) | _present(
            F.try_variant_get(variant, "$", "string"), variant
        )

    kept = F.filter(entries, lambda e: present(e, "price") & present(e, "size"))
    parsed = F.transform(kept, lambda e: F.struct(e["n"]["price"].alias("px"), e["n"]["size"].alias("sz")))
    return F.when(~F.exists(entries, lambda e: e["v"].isNull()), parsed)


def rank_sides(bids: Column, asks: Column) -> tuple[Column, Column]:
    """Bids by falling price, asks by rising price; equal prices keep their order."""

    def ranked(side: Column, sign: int) -> Column:
        keyed = F.transform(side, lambda e, i: F.struct((e["px"] * sign).alias("k"), i.alias("i"), e["px"].alias("px"), e["sz"].alias("sz")))
        return F.transform(F.array_sort(keyed), lambda e: F.struct(e["px"].alias("px"), e["sz"].alias("sz")))

    return ranked(bids, -1), ranked(asks, 1)


def parse_books(books: DataFrame) -> DataFrame:
    """Book events → one row per snapshot with ranked bids and asks, and `reject`."""
    bids, asks = rank_sides(F.col("_bids"), F.col("_asks"))
    sides = books.withColumns({"_bids": side_entries("bids"), "_asks": side_entries("asks")})
    sides = sides.withColumns({"_bids": parse_side(F.col("_bids")), "_asks": parse_side(F.col("_asks"))})
    rows = _with_event_time(sides, accept_digit_strings=False).select(
        "exchange_ts",
        F.col("receipt_ts").alias("local_ts"),
        _first_key("market").alias("market_id"),
        F.coalesce(_first_key("asset_id"), F.lit("")).alias("token_id"),
        bids.alias("bids"),
        asks.alias("asks"),
        F.lit("websocket").alias("source"),
        "event",
    )
    unreadable = F.lit(False)
    for side in ("bids", "asks"):
        unreadable = unreadable | F.exists(side, lambda e: e["px"].isNull() | e["sz"].isNull())
    return rows.withColumns(
        {
            "condition_id": F.col("market_id"),
            "reject": F.when(F.col("exchange_ts").isNull(), "time out of range")
            .when(F.col("bids").isNull() | F.col("asks").isNull(), "a book side is not an array of objects")
            .when(unreadable, "price or size is not a number"),
        }
    )


def unfold_levels(books: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Ranked books → one row per level: bid i beside ask i, nulls where a side is shorter. Rejected books give none.

    The rejected are left out inside the generator, not by a filter: Spark would push a filter below the
    parsing and parse every book twice.
    """
    zipped = F.when(F.col("reject").isNull(), F.slice(F.arrays_zip("bids", "asks"), 1, depth))
    lead = ["exchange_ts", "local_ts", "market_id", "condition_id", "token_id"]
    rows = books.select(*lead, "source", F.posexplode(zipped).alias("_i", "_pair"))
    return rows.select(
        *lead,
        (F.col("_i") + 1).cast("short").alias("level"),
        F.col("_pair.bids.px").alias("bid_px"),
        F.col("_pair.bids.sz").alias("bid_sz"),
        F.col("_pair.asks.px").alias("ask_px"),
        F.col("_pair.asks.sz").alias("ask_sz"),
        "source",
    )


def event_type_counts(events: DataFrame) -> DataFrame:
    """Events per type, most frequent first."""
    kinds = events.select(F.coalesce(event_type(), F.lit("unknown")).alias("event_type"))
    return kinds.groupBy("event_type").agg(F.count(F.lit(1)).alias("events")).orderBy(F.desc("events"), "event_type")


def event_type_samples(events: DataFrame, n: int = 3) -> DataFrame:
    """The first `n` events of every type; the rank limit is applied before the shuffle too."""
    rows = events.select(
        F.coalesce(event_type(), F.lit("unknown")).alias("event_type"), "receipt_ts", F.to_json("event").alias("event")
    )
    first = W.partitionBy("event_type").orderBy("receipt_ts", "event")
    return rows.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= n).drop("_rn")
