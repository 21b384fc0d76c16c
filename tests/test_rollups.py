"""Partial rows per minute: merged, late and repeated batches, through the ingest query too."""

import json

import pytest
from pyspark.sql import functions as F

from marketflow.operators import rollups
from marketflow.plans import trades as plain
from marketflow.sources.tables import load, prepare_trades, write_levels, write_rollups, write_trades
from marketflow.streaming.ingest import IngestConfig, start_ingest
from tests.conftest import rows


def batches_of(df, n):
    numbered = df.withColumn("_b", F.pmod(F.xxhash64("trade_id"), F.lit(n)))
    return [numbered.filter(F.col("_b") == b).drop("_b") for b in range(n)]


def near(a, b):
    a, b = rows(a), rows(b)
    assert len(a) == len(b) > 0
    for x, y in zip(a, b, strict=True):
        assert x[:-2] == y[:-2] and x[-2:] == pytest.approx(y[-2:])


def test_late_and_repeated_batches(spark, tables, tmp_path):
    root, parts = str(tmp_path), batches_of(tables.trades, 3)
    for number in (1, 0, 2, 0):  # in any order, one of them twice
        write_rollups(parts[number], tables.levels.filter("level = 1"), root, "w", number)
    minutes = load(spark, root, "trade_minutes")
    stored = prepare_trades(tables.trades)
    near(rollups.bucket_volume(minutes), plain.bucket_volume(stored, "5 minutes"))
    near(rollups.bucket_volume(minutes, "1 hour", by_token=False), plain.bucket_volume(stored, "1 hour", by_token=False))
    assert rows(rollups.trades_per_minute(minutes)) == rows(plain.trades_per_minute(stored))
    assert minutes.count() > rows(rollups.trade_minutes(stored).agg(F.count(F.lit(1))))[0][0] * 0.99
    with pytest.raises(ValueError):
        rollups.bucket_volume(minutes, "90 seconds")


def test_sketches_unite(spark, tmp_path):
    root = str(tmp_path)
    many = spark.range(60_000).selectExpr(
        "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, id % 50) AS exchange_ts", "concat('c', id % 20000) AS condition_id",
        "concat('t', id % 30000) AS token_id", "'BUY' AS side", "0.5D AS price", "1D AS size", "cast(id AS string) AS trade_id",
    )
    levels = many.selectExpr("exchange_ts", "condition_id", "concat('b', token_id) AS token_id", "1 AS level", "0.5D AS bid_px", "0.5D AS ask_px", "1D AS bid_sz", "1D AS ask_sz").filter("token_id < 'bt2'")
    for number, part in enumerate(batches_of(many, 4)):
        write_rollups(part, levels, root, "w", number)
    found = {r.seen_in: r for r in rollups.distinct_seen(load(spark, root, "minute_sketches")).collect()}
    books = levels.select("token_id").distinct().count()
    for name, tokens in (("trades_raw", 30_000), ("orderbook_levels", books), (None, 30_000 + books)):
        assert found[name].tokens == pytest.approx(tokens, rel=0.02)
    assert found["trades_raw"].rows == 60_000 and found["trades_raw"].markets == pytest.approx(20_000, rel=0.02)
    hour = load(spark, root, "minute_sketches").filter("minute >= timestamp'2024-01-01 00:40:00'")
    exact = many.filter("exchange_ts >= timestamp'2024-01-01 00:40:00'").select("token_id").distinct().count()
    assert {r.seen_in: r for r in rollups.distinct_seen(hour).collect()}["trades_raw"].tokens == pytest.approx(exact, rel=0.02)


def test_a_row_ten_minutes_late_changes_its_bucket_once(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    source.mkdir()

    def land(name, at, size):
        event = {"event_type": "trade", "timestamp": at, "asset_id": "T", "market": "C", "side": "BUY", "price": "0.5", "size": size, "id": name}
        (source / f"{name}.txt").write_text(json.dumps(event))
        query = start_ingest(spark, IngestConfig(source=str(source), root=root, checkpoint=str(tmp_path / "cp"), available_now=True))
        query.awaitTermination(120)
        assert query.exception() is None
        return str(query.id)

    def volumes():
        return [(r.time.minute, r.buy_volume) for r in rollups.bucket_volume(load(spark, root, "trade_minutes"), "1 minute").collect()]

    land("a", 1700000040000, 10)
    land("b", 1700000700000, 20)
    writer = land("late", 1700000041000, 6)
    assert volumes() == [(14, 8.0), (25, 10.0)]
    batch = load(spark, root, "trades_raw").filter("trade_id = 'late'")
    number = batch.first().batch_id
    again = batch.select(*[c for c in batch.columns if c not in ("event_month", "writer", "batch_id")])
    write_rollups(again, load(spark, root, "orderbook_levels"), root, writer, number)
    assert volumes() == [(14, 8.0), (25, 10.0)]
    assert load(spark, root, "trades_raw").count() == 3


def test_empty_batches(spark, tables, tmp_path):
    root = str(tmp_path)
    write_rollups(tables.trades.limit(0), tables.levels.limit(0), root, "w", 0)
    write_trades(tables.trades.limit(0), root, "w", 0)
    write_levels(tables.levels.limit(0), root, "w", 0)
    assert load(spark, root, "trade_minutes").count() == 0 == load(spark, root, "trades_raw").count()
    assert rollups.distinct_seen(load(spark, root, "minute_sketches")).filter("rows > 0").count() == 0
