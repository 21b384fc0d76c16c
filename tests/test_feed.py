import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketflow.operators import feed
from marketflow.sources.messages import explode_events
from tests.conftest import rows

RECEIPT = datetime(2024, 1, 1)


def events(spark, *messages):
    lines = [(m if isinstance(m, str) else json.dumps(m),) for m in messages]
    df = spark.createDataFrame(lines, "value string").withColumn("receipt_ts", F.lit("2024-01-01").cast("timestamp"))
    return explode_events(df)


def one_trade(spark, **event):
    return feed.normalize_trades(events(spark, event)).first()


def one_book(spark, **event):
    return feed.parse_books(events(spark, event)).first()


def test_messages(spark):
    got = events(spark, "", " \t", "{bad", "7", '"text"', {"a": 1}, [{"b": 1}, {"c": 2}, 5], "[]")
    assert got.count() == 3


@pytest.mark.parametrize(
    "event, kind",
    [
        ({"event_type": "trade"}, "trade"),
        ({"event_type": "last_trade_price"}, "trade"),
        ({"type": "TRADE"}, "trade"),
        ({"event_type": "", "type": "execution"}, "trade"),
        ({"event_type": None, "type": "trade_executed"}, "trade"),
        ({"event_type": 0, "type": "book"}, "book"),
        ({"event_type": False, "type": "BOOK"}, "book"),
        ({"event_type": "0", "type": "book"}, None),
        ({"price": 1, "size": 2, "side": None}, "trade"),
        ({"event_type": "price_change", "price": 1, "size": 2, "side": "BUY"}, "trade"),
        ({"price": 1, "size": 2, "side": "BUY", "bids": []}, "book"),
        ({"price": 1, "size": 2, "side": "BUY", "asks": None}, "book"),
        ({"event_type": "trade", "bids": []}, "trade"),
        ({"event_type": "price_change", "price": 1}, None),
        ({"event_type": "anything", "asks": []}, "book"),
        ({}, None),
    ],
)
def test_classify(spark, event, kind):
    assert feed.classify(events(spark, event)).first()["kind"] == kind


@pytest.mark.parametrize(
    "event, trade_ts, book_ts",
    [
        ({"timestamp": 1700000000123}, datetime(2023, 11, 14, 22, 13, 20, 123000), datetime(2023, 11, 14, 22, 13, 20, 123000)),
        ({"timestamp": 1700000000000.5}, datetime(2023, 11, 14, 22, 13, 20, 500), datetime(2023, 11, 14, 22, 13, 20, 500)),
        ({"timestamp": "1700000000123"}, datetime(2023, 11, 14, 22, 13, 20, 123000), RECEIPT),
        ({"timestamp": "1700000000.5"}, RECEIPT, RECEIPT),
        ({"timestamp": "soon"}, RECEIPT, RECEIPT),
        ({"timestamp": 0, "ts": 1700000000123}, datetime(2023, 11, 14, 22, 13, 20, 123000), datetime(2023, 11, 14, 22, 13, 20, 123000)),
        ({"timestamp": "", "ts": 0}, datetime(1970, 1, 1), datetime(1970, 1, 1)),
        ({"timestamp": None}, RECEIPT, RECEIPT),
        ({"timestamp": "0", "ts": 1700000000123}, datetime(1970, 1, 1), RECEIPT),
        ({}, RECEIPT, RECEIPT),
        ({"timestamp": 10**20}, None, None),
    ],
)
def test_times(spark, event, trade_ts, book_ts):
    assert one_trade(spark, **event)["exchange_ts"] == trade_ts
    assert one_book(spark, **event)["exchange_ts"] == book_ts


def test_trade_fallbacks(spark):
    t = one_trade(spark, asset="A", condition_id="C", price="0.25", size=3, trade_id=9, side="SELL", outcome_index=1)
    assert (t.token_id, t.market_id, t.condition_id, t.price, t.size, t.trade_id) == ("A", "C", "C", 0.25, 3.0, "9")
    assert (t.side, t.outcome, t.outcome_index, t.maker_address, t.source, t.reject) == ("SELL", "", 1, "", "websocket", None)
    t = one_trade(spark, asset_id=None, asset="A", market=None, condition_id="C")
    assert (t.token_id, t.market_id, t.condition_id) == ("", None, "C")
    t = one_trade(spark)
    assert (t.token_id, t.market_id, t.side, t.price, t.size, t.reject) == ("", "", "UNKNOWN", 0.0, 0.0, None)


@pytest.mark.parametrize(
    "event, reason",
    [
        ({"price": "x"}, "price or size is not a number"),
        ({"price": None}, "price or size is not a number"),
        ({"size": "1d"}, "price or size is not a number"),
        ({"side": "buy"}, "unknown side"),
        ({"outcome_index": 256}, "outcome_index is no number from 0 to 255"),
        ({"outcome_index": -1}, "outcome_index is no number from 0 to 255"),
        ({"outcome_index": "first"}, "outcome_index is no number from 0 to 255"),
        ({"outcome_index": 10**9}, "outcome_index is no number from 0 to 255"),
        ({"outcome_index": "255"}, None),
        ({"side": None}, "unknown side"),
        ({"timestamp": 10**20}, "time out of range"),
    ],
)
def test_rejected_trades(spark, event, reason):
    assert one_trade(spark, **event)["reject"] == reason


def test_check_side(spark):
    df = spark.createDataFrame([("BUY",), ("SELL",), ("UNKNOWN",), ("HOLD",), (None,)], "side string")
    good, bad = feed.check_side(df)
    assert (good.count(), bad.count()) == (3, 2)


def test_book_sides(spark):
    b = one_book(
        spark,
        bids=[
            {"price": "0.4", "size": "0"},
            {"price": 0.41, "size": 3},
            {"price": "0.39", "size": 0},
            {"price": "", "size": 1},
            {"price": 0.0, "size": 1},
            {"size": 1},
            {"price": None, "size": 1},
            {"price": "0.41", "size": 8},
        ],
        asks=[{"price": 0.6, "size": 1}, {"price": "0.55", "size": "2"}],
    )
    assert [tuple(x) for x in b.bids] == [(0.41, 3.0), (0.41, 8.0), (0.4, 0.0)]
    assert [tuple(x) for x in b.asks] == [(0.55, 2.0), (0.6, 1.0)]
    assert b.reject is None


@pytest.mark.parametrize("bids", [None, "x", [1], [["0.4", "1"]], [{"price": "x", "size": 1}]])
def test_rejected_books(spark, bids):
    parsed = feed.parse_books(events(spark, {"event_type": "book", "bids": bids}))
    assert parsed.first()["reject"] is not None
    assert feed.unfold_levels(parsed).count() == 0


def test_levels_pair_sides_and_stop_at_ten(spark):
    book = {
        "asset_id": "T",
        "market": "C",
        "bids": [{"price": i / 100, "size": i} for i in range(1, 13)],
        "asks": [{"price": 0.5 + i / 100, "size": i} for i in range(1, 4)],
    }
    got = rows(feed.unfold_levels(feed.parse_books(events(spark, book))), "level", "bid_px", "ask_px")
    assert sorted(got)[:4] == [(1, 0.12, 0.51), (2, 0.11, 0.52), (3, 0.1, 0.53), (4, 0.09, None)]
    assert len(got) == 10
    assert feed.unfold_levels(feed.parse_books(events(spark, {"event_type": "book"}))).count() == 0


def test_event_types(spark):
    df = events(spark, *[{"type": "a", "n": i} for i in range(5)], {"event_type": "b"}, {})
    assert [tuple(r) for r in feed.event_type_counts(df).collect()] == [("a", 5), ("b", 1), ("unknown", 1)]
    assert feed.event_type_samples(df, 3).count() == 5
