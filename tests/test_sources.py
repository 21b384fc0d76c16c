import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketflow import schemas
from marketflow.operators.dimension import enrich, latest_markets, token_map
from marketflow.sources import documents, tables, texts
from tests.conftest import rows


def land(path, name, *docs):
    file = path / name
    file.write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs))
    return str(file)


def test_market_documents(spark, tmp_path):
    full = {
        "id": 12,
        "conditionId": "0xc",
        "clobTokenIds": '["t1", "t2"]',
        "outcomes": ["Yes", "No"],
        "endDate": "2025-01-02T03:04:05Z",
        "events": [
            {"id": 7, "slug": "s", "title": "T", "startDate": "2024-12-31T00:00:00.5Z", "endDate": "never",
             "tags": [{"label": "A"}, {"label": ""}, {"x": 1}, {"label": "B"}]},
            {"id": 8},
        ],
        "question": "Q", "slug": "q", "category": "Sports", "active": True, "closed": False,
        "volumeNum": "12.5", "liquidityNum": None, "bestBid": 0.4, "bestAsk": "x",
    }
    bare = {"id": "13", "clobTokenIds": ["t3"], "events": "[]", "endDate": "bad", "active": 0}
    path = land(tmp_path, "m.json", full, bare)
    a, b = sorted(documents.read_markets(spark, path).collect(), key=lambda r: r.market_id)
    assert (a.market_id, a.condition_id, a.clob_token_ids, a.outcomes) == ("12", "0xc", ["t1", "t2"], ["Yes", "No"])
    assert (a.event_id, a.event_slug, a.event_title, a.event_tags) == ("7", "s", "T", ["A", "B"])
    assert (a.end_date, a.event_start_date, a.event_end_date) == (
        datetime(2025, 1, 2, 3, 4, 5), datetime(2024, 12, 31, 0, 0, 0, 500000), None)
    assert (a.active, a.closed, a.volume_total, a.liquidity, a.best_bid, a.best_ask) == (1, 0, 12.5, 0.0, 0.4, 0.0)
    assert (b.condition_id, b.event_id, b.event_tags, b.end_date, b.category) == ("", "", [], None, "Unknown")
    assert (b.clob_token_ids, b.outcomes, b.active, b.closed) == (["t3"], [], 0, 0)


def test_event_documents(spark, tmp_path):
    path = land(tmp_path, "e.json", {"id": 1, "slug": "s", "title": "T", "endDate": "2025-01-01T00:00:00Z",
                                     "tags": [{"label": "A"}, {}], "markets": [{"id": 5}]}, {"id": 2, "tags": None})
    a, b = sorted(documents.read_events(spark, path).collect(), key=lambda r: r.event_id)
    assert (a.event_id, a.event_tags, a.event_end_date, json.loads(a.markets[0])) == ("1", ["A"], datetime(2025, 1, 1), {"id": 5})
    assert (b.event_slug, b.event_tags, b.markets) == ("", [], [])


def test_rest_trades_take_their_market_from_the_token(spark, tmp_path):
    path = land(tmp_path, "t.json", {"timestamp": 1700000000, "conditionId": "C1", "asset": "T1", "side": "BUY", "price": 0.5,
                                     "size": "3", "outcomeIndex": 1, "transactionHash": "0x1", "proxyWallet": "w"})
    trades = documents.read_rest_trades(spark, path)
    t = trades.first()
    assert (t.exchange_ts, t.maker_address, t.taker_address, t.source) == (datetime(2023, 11, 14, 22, 13, 20), None, "w", "data_api")
    dim = spark.createDataFrame([("T1", "C1", "M1")], "token_id string, condition_id string, market_id string")
    assert enrich(trades, dim).first()["market_id"] == "M1"


def test_rest_books(spark, tmp_path):
    path = land(tmp_path, "b.json", {"market": "C", "asset_id": "T", "bids": [{"price": "0.1", "size": "1"}, {"price": "0.3", "size": "2"}],
                                     "asks": [{"price": "0.9", "size": "5"}, {"price": "0.7", "size": "6"}], "last_trade_price": ""},
                {"market": "D", "bids": [], "asks": []})
    a, b = sorted(documents.read_rest_books(spark, path).collect(), key=lambda r: r.market_id)
    assert (a.bid_px, a.bid_sz, a.ask_px, a.ask_sz, a.last_trade_price, a.source) == (0.3, 2.0, 0.7, 6.0, 0.0, "clob_rest")
    assert (b.bid_px, b.ask_sz) == (None, None)


def test_category_map(spark, tmp_path):
    path = land(tmp_path, "c.json", '{"1": "Politics",\n "2": "Crypto"}')
    assert rows(texts.read_category_map(spark, path)) == [("1", "Politics"), ("2", "Crypto")]
    assert texts.read_category_map(spark, str(tmp_path / "none.json")).count() == 0


def test_titles(spark, tmp_path):
    land(tmp_path, "a.txt", "Header 1: no", "", *[f"{i}: Title {i}: x" for i in range(7, 0, -1)])
    land(tmp_path, "b.txt", "8: Last")
    titles = texts.read_title_corpus(spark, str(tmp_path / "*.txt"))
    assert titles.count() == 8
    packed = texts.pack_titles(titles, 3).orderBy("batch").collect()
    assert [(p.batch, p.titles) for p in packed] == [(0, 3), (1, 3), (2, 2)]
    assert packed[0].text == "1: Title 1: x\n2: Title 2: x\n3: Title 3: x"
    assert packed[2].text.endswith("8: Last")


def test_write_and_scan(spark, tables_fixture, tmp_path):
    root = str(tmp_path)
    t = tables_fixture
    tables.write_trades(t.trades, root)
    tables.write_levels(t.levels, root)
    trades, levels = tables.load(spark, root, "trades_raw"), tables.load(spark, root, "orderbook_levels")
    assert trades.count() == t.trades.count()
    dropped = t.levels.filter("coalesce(bid_px, bid_sz, ask_px, ask_sz) IS NULL").count()
    assert dropped > 0 and levels.count() == t.levels.count() - dropped
    assert [f.name for f in trades.schema.fields][:15] == schemas.TRADES.names
    assert trades.select("maker_address", "source").distinct().collect() == [("", "websocket")]
    assert trades.filter("delta_t_ms <> cast(unix_millis(local_ts) - unix_millis(exchange_ts) as float)").count() == 0
    assert {r[0] for r in trades.select("event_month").distinct().collect()} == {"202401"}


@pytest.fixture
def tables_fixture(tables):
    return tables


def test_time_filter_prunes_months_and_reaches_the_scan(spark, tmp_path, capsys):
    from marketflow.operators.filters import for_token, lookback

    days = spark.sql("SELECT explode(sequence(timestamp'2024-01-15', timestamp'2024-04-15', interval 1 month)) AS exchange_ts")
    tables.write_trades(days.withColumns({"condition_id": F.lit("c"), "price": F.lit(0.5), "size": F.lit(1.0)}), str(tmp_path))
    df = for_token(lookback(tables.load(spark, str(tmp_path), "trades_raw"), "2024-04-16 00:00:00", "40 DAYS"), "c")
    assert df.count() == 2
    df.select("price").explain("formatted")
    plan = capsys.readouterr().out
    assert "event_month#" in plan.split("PartitionFilters: [")[1].split("\n")[0]
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(exchange_ts" in pushed and "EqualTo(condition_id,c)" in pushed
    assert "taker_address" not in plan.split("ReadSchema")[1]


def test_schema_alignment(spark):
    df = spark.createDataFrame([("m", None)], "market_id string, category string")
    row = tables.align_schema(df, "markets_dim").first()
    assert (row.market_id, row.category, row.computed_category, row.event_tags, row.volume_total) == ("m", "Unknown", "Other", [], 0.0)
    assert tables.missing_columns(df, ["market_id", "slug"]) == ["slug"]
    assert tables.missing_columns(spark.createDataFrame([], schemas.TRADES), schemas.REQUIRED["trades_raw"]) == []


def test_market_versions_and_compaction(spark, tables_fixture, tmp_path):
    root, target = str(tmp_path / "a"), str(tmp_path / "b")
    base = spark.createDataFrame([("m1", "c1", ["t1"]), ("m2", "c2", ["t2"])], "market_id string, condition_id string, clob_token_ids array<string>")
    tables.write_markets(base.withColumn("question", F.lit("old")), root, now="2024-01-01 00:00:00", batch_id=0)
    tables.write_markets(base.limit(1).withColumn("question", F.lit("new")), root, now="2024-01-02 00:00:00", batch_id=1)
    stored = tables.load(spark, root, "markets_dim")
    assert stored.count() == 3
    tables.compact(spark, root, target, "markets_dim")
    compacted = tables.load(spark, target, "markets_dim")
    assert rows(compacted, "market_id", "question") == [("m1", "new"), ("m2", "old")]
    assert rows(token_map(compacted)) == rows(token_map(stored))
    assert rows(latest_markets(stored), "market_id", "question") == rows(compacted, "market_id", "question")
    with pytest.raises(ValueError):
        tables.compact(spark, root, root + "/", "markets_dim")


def test_compaction_keeps_every_trade(spark, tables_fixture, tmp_path):
    root, target = str(tmp_path / "a"), str(tmp_path / "b")
    for batch in range(3):
        tables.write_trades(tables_fixture.trades, root, "w", batch, cluster=False)
    tables.compact(spark, root, target, "trades_raw")
    assert tables.load(spark, target, "trades_raw").count() == 3 * tables_fixture.trades.count()


def test_unreadable_documents_are_set_apart(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"id": "1", "endDate": "12:30"}\n[\n{"id": "2", "endDate": "2024-05-06"}\n{"id": \n]\n')
    found = {r.market_id: r.end_date for r in documents.read_markets(spark, str(tmp_path)).collect()}
    assert set(found) == {"1", "2"} and found["1"] is None and found["2"] is not None
    rejected = documents.read_rejected(spark, str(tmp_path), schemas.MARKET_DOC)
    assert sorted(r.text.strip() for r in rejected.collect()) == ["[", "]", '{"id":']


def test_pages_of_documents(spark, tmp_path):
    (tmp_path / "page.json").write_text('[\n{"id": "1"},\n{"id": "2"}\n]\n')
    assert sorted(r.market_id for r in documents.read_markets(spark, str(tmp_path), pages=True).collect()) == ["1", "2"]


def test_trades_outside_the_domain_are_set_apart(spark, tmp_path):
    df = spark.sql("SELECT timestamp '2024-01-01' AS exchange_ts, 'c' AS condition_id, side FROM VALUES ('BUY'), ('LEFT') AS t(side) "
                   "UNION ALL SELECT CAST(NULL AS TIMESTAMP), 'c', 'SELL'")  # fmt: skip
    tables.write_trades(df, str(tmp_path))
    assert [r.side for r in tables.load(spark, str(tmp_path), "trades_raw").collect()] == ["BUY"]
    assert sorted(r.side for r in spark.read.parquet(f"{tmp_path}/rejected_trades").collect()) == ["LEFT", "SELL"]
