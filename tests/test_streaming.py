import json
import time

import pytest
from pyspark.sql import functions as F

from marketflow.operators.dimension import enrich, token_map
from marketflow.operators.feed import classify, normalize_trades, parse_books, unfold_levels
from marketflow.sources.messages import read_messages
from marketflow.sources.tables import load, load_stream, prepare_levels, prepare_trades, write_levels, write_markets, write_trades
from marketflow.streaming.ingest import IngestConfig, IngestStats, start_ingest
from marketflow.streaming.live import stream_counts, stream_quotes, stream_volume
from tests.conftest import rows

BOOK = {"event_type": "book", "timestamp": 1700000001000, "asset_id": "T1", "market": "C1"}
MESSAGES = [
    "   ",
    "{not json",
    json.dumps({"event_type": "trade", "timestamp": 1700000000123, "asset_id": "T1", "market": "C1", "side": "BUY", "price": "0.5", "size": "10", "id": "a"}),
    json.dumps([
        {"type": "last_trade_price", "timestamp": "1700000000500", "asset": "T2", "side": "SELL", "price": 0.4, "size": 3, "id": "b"},
        {"event_type": "trade", "timestamp": 1700000000600, "asset_id": "T9", "market": "C9", "side": "BUY", "price": "bad", "size": 1, "id": "c"},
        {"event_type": "trade", "timestamp": 1700000000700, "asset_id": "T9", "market": "C9", "side": "BUY", "price": 0.1, "size": 1, "id": "d"},
    ]),
    json.dumps({"event_type": "price_change", "asset_id": "T1"}),
    json.dumps({**BOOK, "bids": [{"price": f"0.{i}", "size": i} for i in range(10, 22)], "asks": [{"price": "0.6", "size": "0"}, {"price": 0.7, "size": 0}]}),
    json.dumps({"bids": [], "asks": [{"price": "0.9", "size": "4"}], "asset_id": "T2", "timestamp": 1700000002000}),
]


def markets(spark):
    return spark.createDataFrame(
        [("M1", "C1", ["T1", "T2"])], "market_id string, condition_id string, clob_token_ids array<string>"
    )


def ingest(spark, tmp_path, stats=None, name="source"):
    cfg = IngestConfig(
        source=str(tmp_path / name), root=str(tmp_path / "root"), checkpoint=str(tmp_path / "cp"), available_now=True
    )
    query = start_ingest(spark, cfg, stats)
    query.awaitTermination(120)
    assert query.exception() is None
    return cfg


@pytest.fixture
def landed(spark, tmp_path):
    (tmp_path / "source").mkdir()
    (tmp_path / "source" / "one.txt").write_text("\n".join(MESSAGES))
    write_markets(markets(spark), str(tmp_path / "root"), now="2024-01-01 00:00:00")
    return tmp_path


def test_ingest_equals_batch_transform_and_survives_restart(spark, landed):
    stats = IngestStats()
    cfg = ingest(spark, landed, stats)
    tokens = token_map(load(spark, cfg.root, "markets_dim"))
    events = classify(read_messages(spark, cfg.source, streaming=False))
    trades = normalize_trades(events.filter("kind = 'trade'"))
    levels = unfold_levels(parse_books(events.filter("kind = 'book'")))
    columns = ["exchange_ts", "market_id", "condition_id", "token_id"]
    want_trades = rows(enrich(trades.filter("reject IS NULL"), tokens), *columns, "price", "size", "trade_id")
    want_levels = rows(enrich(levels, tokens), *columns, "level", "bid_px", "bid_sz", "ask_px", "ask_sz")

    def stored():
        return (
            rows(load(spark, cfg.root, "trades_raw"), *columns, "price", "size", "trade_id"),
            rows(load(spark, cfg.root, "orderbook_levels"), *columns, "level", "bid_px", "bid_sz", "ask_px", "ask_sz"),
        )

    assert stored() == (want_trades, want_levels)
    assert [t[-1] for t in want_trades] == ["a", "b", "d"]
    assert {t[1:3] for t in want_trades} == {("M1", "C1"), ("C9", "C9")}
    assert len(want_levels) == 11
    rejected = spark.read.parquet(f"{cfg.root}/rejected_events").collect()
    assert [r["reject"] for r in rejected] == ["price or size is not a number"]

    for _ in range(100):
        if stats.totals["events_received"]:
            break
        time.sleep(0.1)
    assert stats.totals == {
        "events_received": 7,
        "trades_received": 4,
        "books_received": 2,
        "trades_written": 3,
        "levels_written": 11,
        "rejected": 1,
    }
    spark.streams.removeListener(stats)

    ingest(spark, landed)
    assert stored() == (want_trades, want_levels)

    (landed / "source" / "two.txt").write_text(MESSAGES[2].replace('"a"', '"z"'))
    ingest(spark, landed)
    assert [t[-1] for t in stored()[0]].count("z") == 1
    assert len(stored()[0]) == 4


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    trades = spark.createDataFrame([("t",)], "trade_id string").withColumn(
        "exchange_ts", F.lit("2024-01-01 00:00:00").cast("timestamp")
    ).withColumns({"price": F.lit(0.5), "size": F.lit(1.0)})
    for writer, batch in (("w", 0), ("w", 0), ("w", 1), ("other", 0)):
        write_trades(trades, str(tmp_path), writer, batch)
    assert load(spark, str(tmp_path), "trades_raw").count() == 3


def test_ingest_without_a_dimension_keeps_the_feed_ids(spark, tmp_path):
    (tmp_path / "source").mkdir()
    (tmp_path / "source" / "one.txt").write_text(MESSAGES[2])
    cfg = ingest(spark, tmp_path)
    assert rows(load(spark, cfg.root, "trades_raw"), "market_id", "condition_id") == [("C1", "C1")]


def drain(df, name, mode):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert query.exception() is None
    return df.sparkSession.table(name)


def test_live_aggregates_equal_the_batch_ones(spark, tables, tmp_path):
    root = str(tmp_path)
    write_trades(tables.trades, root)
    write_levels(tables.levels, root)
    trades = load_stream(spark, root, "trades_raw")
    levels = load_stream(spark, root, "orderbook_levels")

    counts = drain(stream_counts(trades, "1 hour"), "live_counts", "complete")
    want = prepare_trades(tables.trades).groupBy(F.date_trunc("hour", "exchange_ts").alias("time")).count()
    assert rows(counts) == rows(want)

    volume = drain(stream_volume(trades, "1 day"), "live_volume", "complete")
    sums = volume.agg(F.round(F.sum("buy_volume"), 4), F.round(F.sum("sell_volume"), 4)).first()
    value = F.col("price") * F.col("size")
    both = tables.trades.agg(
        F.sum(F.when(F.col("side") == "BUY", value)).cast("double"), F.sum(F.when(F.col("side") == "SELL", value)).cast("double")
    ).first()
    assert tuple(sums) == pytest.approx(tuple(both))

    quotes = drain(stream_quotes(levels), "live_quotes", "complete")
    newest = (
        prepare_levels(tables.levels)
        .filter("level = 1 AND bid_px IS NOT NULL AND ask_px IS NOT NULL")
        .groupBy("token_id")
        .agg(F.max("exchange_ts").alias("exchange_ts"))
    )
    assert rows(quotes, "token_id", "exchange_ts") == rows(newest, "token_id", "exchange_ts")
    assert all(abs(r.yes_pct + r.no_pct - 100) < 1e-9 for r in quotes.collect())
