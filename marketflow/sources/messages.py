"""Feed messages: landed text lines, files or a Kafka topic → one row per JSON event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The keys of a feed event.
FIELDS = (
    "event_type",
    "type",
    "timestamp",
    "ts",
    "asset_id",
    "asset",
    "market",
    "condition_id",
    "side",
    "price",
    "size",
    "outcome",
    "outcome_index",
    "id",
    "trade_id",
    "maker",
    "taker",
)
SIDES = ("bids", "asks")


def raw_messages(spark: SparkSession, path: str, streaming: bool = True, fmt: str = "text", **options) -> DataFrame:
    """Rows with `value` and, where the landed file has it, `receipt_ts`.

    `fmt`: 'text' (one message per line), 'json' or 'parquet' (columns receipt_ts and value), or 'kafka'
    (then `path` is the topic and the broker list comes by option).
    """
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**options)
    if fmt == "kafka":
        return reader.option("subscribe", path).load().select(
            F.col("value").cast("string").alias("value"), F.col("timestamp").alias("receipt_ts")
        )
    if fmt in ("json", "parquet"):
        reader = reader.schema("receipt_ts timestamp, value string")
    return reader.load(path)


def explode_events(messages: DataFrame) -> DataFrame:
    """Messages → (receipt_ts, event, f, t): the event as a variant, its known fields as variants and as texts.

    Blank and invalid messages are skipped; an array gives one row per element; what is no object drops out.
    """
    stamped = messages if "receipt_ts" in messages.columns else messages.withColumn("receipt_ts", F.current_timestamp())
    parsed = stamped.filter(F.trim("value") != "").select(
        "receipt_ts", F.ltrim("value").startswith("[").alias("_list"), F.try_parse_json("value").alias("_v")
    )
    elements = F.when(F.col("_list"), F.try_variant_get("_v", "$", "array<variant>")).otherwise(F.array("_v"))
    # The fields are read inside the generator: later filters use them many times and Spark would push each
    # use, with the whole reading in it, below a projection, but not below a generator.
    variants = ", ".join(f"{name}: variant" for name in (*FIELDS, *SIDES))
    texts = ", ".join(f"{name}: string" for name in FIELDS)
    read = F.transform(
        elements,
        lambda v: F.struct(
            v.alias("event"),
            F.try_variant_get(v, "$", f"struct<{variants}>").alias("f"),
            F.try_variant_get(v, "$", f"struct<{texts}>").alias("t"),
        ),
    )
    return parsed.select("receipt_ts", F.inline(read)).filter(F.col("f").isNotNull())


def read_messages(spark: SparkSession, path: str, streaming: bool = True, fmt: str = "text", **options) -> DataFrame:
    return explode_events(raw_messages(spark, path, streaming, fmt, **options))
