import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketflow.functions import aggregates as agg
from marketflow.functions import metrics as m
from marketflow.operators import dimension, filters, joins, running
from marketflow.operators.book import book_levels, rank_book
from marketflow.operators.distribution import heatmap, histogram
from marketflow.plans import book, health, markets, trades
from tests.conftest import rows

START = datetime(2024, 1, 1)


def skewed(spark, n=600, distinct=40):
    """Two thirds of the rows in one key, many equal times, times across several minutes."""
    rng = random.Random(7)
    data = [
        ("hot" if i % 3 else f"k{i % 7}", START + timedelta(seconds=rng.randrange(distinct) * 13), f"t{i:04d}", rng.randrange(1000))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "k string, exchange_ts timestamp, trade_id string, v long").repartition(5)


def test_cumulative_equals_the_plain_window(spark):
    df = skewed(spark)
    plain = W.partitionBy("k").orderBy("exchange_ts").rangeBetween(W.unboundedPreceding, W.currentRow)
    want = df.select("k", "exchange_ts", F.sum("v").over(plain).cast("double").alias("s"))
    for bucket in ("second", "minute", "hour"):
        got = running.cumulative(df, {"s": F.col("v")}, ["k"], bucket=bucket)
        assert rows(got) == rows(want)
    per_time = running.cumulative(df, {"s": F.col("v")}, ["k"], per_row=False)
    assert rows(per_time) == rows(want.distinct())


def test_cumulative_repeats_long_ties(spark, monkeypatch):
    monkeypatch.setattr(running, "REPEAT_CHUNK", 4)
    df = skewed(spark, 300, 3)
    plain = W.partitionBy("k").orderBy("exchange_ts").rangeBetween(W.unboundedPreceding, W.currentRow)
    want = df.select("k", "exchange_ts", F.sum("v").over(plain).cast("double").alias("s"))
    assert rows(running.cumulative(df, {"s": F.col("v")}, ["k"])) == rows(want)


def test_cumulative_reads_its_input_once(spark, tables, capsys):
    for df in (trades.cumulative_volume(tables.trades), trades.cumulative_delta(tables.trades, with_volume=True)):
        df.collect()
        df.explain()
        plan = capsys.readouterr().out
        assert "ReusedExchange" in plan.split("Initial Plan")[0]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_running_rows_equal_the_plain_window(spark, parts):
    df = skewed(spark)
    plain = W.partitionBy("k").orderBy("exchange_ts", "trade_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    want = df.select("*", F.sum("v").over(plain).cast("double").alias("s"))
    got = running.running_rows(df, {"s": F.col("v")}, ["k"], ["exchange_ts", "trade_id"], parts)
    assert rows(got) == rows(want)


def test_positions_number_all_rows(spark):
    got = running.positions(skewed(spark), [], ["exchange_ts", "trade_id"]).orderBy("exchange_ts", "trade_id").collect()
    assert [r.position for r in got] == list(range(1, len(got) + 1))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_attach_gives_the_same_rows_broadcast_or_salted(spark, how):
    facts = skewed(spark)
    dim = spark.createDataFrame([("hot", "H"), ("k1", None), ("zz", "Z")], "k string, name string")
    want = rows(facts.join(dim, ["k"], how).select("k", "trade_id", "name"))
    for small in (True, False, None):
        assert rows(joins.attach(facts, dim, ["k"], how, small=small).select("k", "trade_id", "name")) == want


def test_only_hot_keys_are_repeated(spark):
    """A key with a third of the facts is spread; of a dimension of a thousand rows only its row is repeated."""
    facts = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE cast(id % 1000 AS int) END AS k", "id")
    dim = spark.range(1000).selectExpr("id AS k", "id * 2 AS twice")  # a key of another type
    hot = joins.hot_keys(facts, ["k"])
    spread, repeated = joins.salted(facts, dim, ["k"], hot, salts=64)
    assert len(hot) == 1 and repeated.count() == 999 + 64
    groups = spread.groupBy("k", "_salt").count()
    assert groups.agg(F.max("count")).first()[0] < 400 and groups.filter("k <> 7 AND _salt <> 0").count() == 0
    assert rows(joins.attach(facts, dim, ["k"], small=False)) == rows(joins.attach(facts, dim, ["k"], small=True))


def test_facts_without_hot_keys(spark):
    facts = spark.range(5000).selectExpr("id AS k", "cast(NULL AS string) AS x")
    assert joins.hot_keys(facts, ["k", "x"]) == [] == joins.hot_keys(facts.limit(0), ["k"])
    nulls = joins.hot_keys(facts, ["x"])
    assert len(nulls) == 1
    dim = spark.createDataFrame([(None, 1), ("a", 2)], "x string, v int")
    assert rows(joins.attach(facts, dim, ["x"], small=False), "v") == [(None,)] * 5000
    assert joins.attach(facts, dim, ["x"], "inner", small=False).count() == 0


def test_series_of_all_markets_are_ordered_on_demand_only(spark, tables):
    def sorts(df):
        return "rangepartitioning" in df._jdf.queryExecution().executedPlan().toString()

    for series, rows_of in ((book.mid_series, tables.levels), (book.ask_depth, tables.levels), (book.depth_points, tables.levels),
                            (trades.cumulative_volume, tables.trades), (trades.price_series, tables.trades)):
        assert not sorts(series(rows_of)) and sorts(series(rows_of, market="c0")) and sorts(series(rows_of, ordered=True))
        assert not sorts(series(rows_of, market="c0", ordered=False))
    times = [r.exchange_ts for r in trades.price_series(tables.trades, market="c0").collect()]
    assert times == sorted(times) and len(times) > 100


def test_broadcast_only_within_the_limit(spark):
    dim = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    assert joins.measured_bytes(dim) == 1000 * 24 + 2890
    assert joins.fits_broadcast(dim) and not joins.fits_broadcast(dim, 1000)
    assert joins.measured_bytes(dim.limit(0)) == 0


def test_band_counts_every_touch(spark):
    data = [("c", "t", 1, 1, 0.50, 10.0), ("c", "t", 1, 2, 0.60, 20.0), ("c", "t", 1, 3, 0.61, 40.0), ("c", "t", 1, 1, 0.55, 5.0),
            ("c", "t", 2, 2, 0.50, 1.0), ("c", "t", 3, 1, None, 1.0), ("c", "t", 4, 1, 0.30, 7.0), ("c", "t", 4, 2, 0.20, 9.0)]
    levels = spark.createDataFrame(data, "condition_id string, token_id string, exchange_ts int, level int, ask_px double, ask_sz double")
    # Snapshot 1 has two touches: 0.50 sees 10+5+20, 0.55 sees 5+20+40.
    assert rows(joins.within_band(levels), "exchange_ts", "depth") == [(1, 100.0), (4, 7.0)]


def test_top_of_book_is_cut_before_the_shuffle(spark, tables, capsys):
    book_levels(tables.orders, ["snapshot"], ["l_orderkey"]).explain()
    plan = capsys.readouterr().out
    assert "row_number(), 10, Partial" in plan and "row_number(), 10, Final" in plan


def test_ranks_agree_with_levels(spark, tables):
    ties = ["l_orderkey", "l_linenumber", "l_suppkey"]
    best = rank_book(tables.orders, ["snapshot"], ties).filter("book_rank = 1 AND side = 'bid'")
    levels = book_levels(tables.orders, ["snapshot"], ties).filter("level = 1 AND bid_px IS NOT NULL")
    assert rows(best, "snapshot", "price") == rows(levels, "snapshot", "bid_px")


def test_argmax_skips_null_values_and_settles_ties(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 5.0), (2, 7.0), (3, None)], "ts int, x double")
    assert df.agg(agg.argmax(F.col("x"), F.col("ts"), F.col("x"))).first()[0] == 7.0
    assert df.filter("ts <> 2 OR x > 6").agg(agg.argmax(F.col("x"), F.col("ts"))).first()[0] == 7.0


def test_empty_sums(spark):
    df = spark.createDataFrame([("SELL", 1.0)], "side string, x double")
    row = df.agg(agg.total_if(F.col("x"), F.col("side") == "BUY"), agg.total(F.col("x")), agg.mean(F.col("x"))).first()
    assert tuple(row) == (0.0, 1.0, 1.0)
    assert tuple(df.filter("false").agg(agg.total(F.col("x")), agg.mean(F.col("x"))).first()) == (None, None)


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(2.5, 0.125, 11.381 / 20)], "a double, b double, c double")
    assert tuple(df.select(agg.rounded(F.col("a"), 0), agg.rounded(F.col("b"), 2), agg.rounded(F.col("c"), 4)).first()) == (2.0, 0.12, 0.569)


def test_scalar_formulas(spark):
    row = spark.range(1).select(
        m.imbalance(F.lit(3.0), F.lit(1.0)),
        m.imbalance(F.lit(0.0), F.lit(0.0)),
        m.pressure(F.lit(0.31)),
        m.pressure(F.lit(-0.31)),
        m.pressure(F.lit(0.3)),
        m.level_label(F.lit(2), "spread"),
        m.level_label(F.lit(4), "spread"),
        m.array_at(F.array(F.lit("a"), F.lit("b")), 2),
        m.array_at(F.array(F.lit("a")), 2),
        m.array_at(F.array(F.lit("a")), 0),
        m.latency_ms(F.lit("2024-01-01 00:00:00.5").cast("timestamp"), F.lit("2024-01-01 00:00:00.25").cast("timestamp")),
        m.month_key(F.lit("2024-02-03").cast("timestamp")),
        m.probability(F.lit(0.123456), yes=False),
        m.signed_notional(F.lit("UNKNOWN"), F.lit(0.5), F.lit(2.0)),
    ).first()
    assert tuple(row) == (0.5, 0.0, "BUY", "SELL", "NEUTRAL", "Spread (Lvl2)", None, "b", None, None, -250.0, "202402", 87.65, -1.0)


@pytest.mark.parametrize("n, text", [(0, "0.00 B"), (1023, "1023.00 B"), (1536, "1.50 KB"), (1024**3, "1.00 GB"), (3 * 1024**5, "3.00 PB")])
def test_readable_bytes(spark, n, text):
    assert spark.range(1).select(m.readable_bytes(F.lit(n))).first()[0] == text


@pytest.mark.parametrize("age, status", [(59, "ACTIVE"), (60, "SLOW"), (299, "SLOW"), (300, "STOPPED"), (None, "NO DATA")])
def test_freshness_status(spark, age, status):
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    last = F.lit(None).cast("timestamp") if age is None else now - F.make_interval(secs=F.lit(age))
    assert spark.range(1).select(m.freshness(last, now)[1]).first()[0] == status


@pytest.mark.parametrize("seen, known, label", [(51, 100, "good"), (50, 100, "medium"), (10, 100, "low"), (5, 0, "low")])
def test_coverage_label(spark, seen, known, label):
    assert spark.range(1).select(m.coverage(F.lit(seen), F.lit(known))[1]).first()[0] == label


def test_lookback_bounds(spark):
    df = spark.sql("SELECT explode(sequence(timestamp'2024-01-01 00:00', timestamp'2024-01-01 06:00', interval 1 hour)) AS exchange_ts")
    assert filters.lookback(df, datetime(2024, 1, 1, 6), "2 HOURS").count() == 3
    assert filters.lookback(df, "2024-01-01 06:00:00", "2 HOURS", inclusive=False).count() == 2
    assert filters.between_ts(df, "2024-01-01 01:00:00", "2024-01-01 03:00:00").count() == 3
    assert filters.lookback(df, None, "1 DAY").count() == 0


def test_values_with_quotes_are_values(spark):
    df = spark.createDataFrame([("a'b", "50%_x"), ("c", "JD Gaming")], "condition_id string, question string")
    assert filters.for_token(df, "a'b").count() == 1
    assert filters.for_token(df, "' OR 1=1 --").count() == 0
    assert filters.matches(df, "question", "jd gaming").count() == 1
    assert filters.matches(df, "question", "jd gaming", case=True).count() == 0
    assert filters.matches(df, "question", "J_ G%").count() == 1


def test_histogram_edges(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 0.5), ("a", 1.0), ("b", 3.0), ("b", 3.0)], "condition_id string, x double")
    assert rows(histogram(df, "x", 2), "condition_id", "bin", "n") == [("a", 0, 1), ("a", 1, 2), ("b", 1, 2)]


def test_heatmap_cells(spark):
    df = spark.createDataFrame([("c", "t", START, 1), ("c", "t", START + timedelta(seconds=59), 1)], "condition_id string, token_id string, exchange_ts timestamp, x int")
    assert heatmap(df, "1 minute", F.col("x"), "x", F.count("*"), "n").first()["n"] == 2


def test_enrichment_order(spark):
    rows_in = [("T1", "old", ""), ("T1", "old", None), ("T1", "old", "C1"), ("T1", "old", "old"), ("T2", "x", "y"), ("", "x", "")]
    df = spark.createDataFrame(rows_in, "token_id string, condition_id string, market_id string")
    tokens = spark.createDataFrame([("T1", "C1", "M1")], "token_id string, condition_id string, market_id string")
    got = rows(dimension.enrich(df, tokens))
    assert got == sorted(
        [("T1", "C1", "M1")] * 3 + [("T1", "C1", "old"), ("T2", "x", "y"), ("", "x", "")], key=repr
    )


@pytest.mark.parametrize(
    "market, category, question, want",
    [
        ("1", "Sports", "x", "Politics"),
        ("2", "Sports", "x", "Sports"),
        ("2", "Tech", "Will A VS B win", "Sports"),
        ("2", "Tech", "cupertino", "Sports"),
        ("2", "Tech", "avs b", "Tech"),
        ("2", "", "x", "Other"),
        ("2", None, None, "Other"),
        ("3", "Tech", "x", "Tech"),
    ],
)
def test_computed_category(spark, market, category, question, want):
    df = spark.createDataFrame([(market, category, question)], "market_id string, category string, question string")
    mapped = spark.createDataFrame([("1", "Politics"), ("3", "")], "market_id string, category string")
    assert dimension.computed_category(df, mapped).first()["computed_category"] == want


def test_latest_takes_one_version_whole(spark):
    data = [("c", "m", 1, "q1", "a"), ("c", "m", 2, "q2", None), ("c", "n", 1, "q3", "b")]
    df = spark.createDataFrame(data, "condition_id string, market_id string, updated_at int, question string, category string")
    assert rows(dimension.latest_markets(df), "market_id", "question", "category") == [("m", "q2", None), ("n", "q3", "b")]


def test_versions_are_dealt_out_before_they_are_sorted(spark, tmp_path, capsys):
    """One task may read all versions: it must not sort them all."""
    wide = "string(id % 50) AS condition_id, string(id % 50) AS market_id, timestamp_seconds(id) AS updated_at, string(id) AS question"
    spark.range(0, 500, 1, 1).selectExpr(*wide.split(", ")).write.parquet(str(tmp_path / "versions"))
    newest = dimension.latest_markets(spark.read.parquet(str(tmp_path / "versions")))
    assert rows(newest, "condition_id", "question") == sorted((str(i % 50), str(i)) for i in range(450, 500))
    newest.explain()
    plan = capsys.readouterr().out
    below = plan[plan.rindex("Exchange") :]
    assert "Scan" in below and "Sort " not in below and "Aggregate" not in below


def test_versions_are_dealt_to_few_parts(spark, monkeypatch):
    """A task that deals rows to many parts would hold them all in memory."""
    df = spark.createDataFrame([("m", "c", 1), ("m", "c", 2)], "market_id string, condition_id string, updated_at int")
    monkeypatch.setattr(dimension, "PARTS", 3)
    newest = dimension.latest_markets(df)
    assert "RepartitionByExpression" in newest._jdf.queryExecution().logical().toString()
    assert ", 3" in newest._jdf.queryExecution().optimizedPlan().toString()
    assert rows(newest) == [("c", "m", 2)]


def test_invariants(spark, tables):
    assert book.imbalance_series(tables.levels).filter("abs(imbalance) > 1").count() == 0
    both = book.current_probability(tables.levels).groupBy("token_id").agg(F.round(F.sum("value"), 6).alias("s"))
    assert both.filter("s <> 100").count() == 0
    last = trades.cumulative_volume(tables.trades).groupBy("token_id").agg(F.max("cum_volume").alias("v"))
    total = tables.trades.groupBy("token_id").agg(F.sum(F.col("price") * F.col("size")).cast("double").alias("v"))
    assert rows(last) == rows(total)
    ladder = W.partitionBy("token_id", "exchange_ts").orderBy("level")
    steps = tables.levels.select(
        (F.col("bid_px") - F.lag("bid_px").over(ladder)).alias("b"), (F.col("ask_px") - F.lag("ask_px").over(ladder)).alias("a")
    )
    assert steps.filter("b > 0 OR a < 0").count() == 0


def test_single_market_arguments(spark, tables):
    whole = trades.bucket_volume(tables.trades, "5 minutes")
    one = trades.bucket_volume(tables.trades, "5 minutes", market="c0", token="c0-1")
    assert rows(one) == rows(whole.filter("condition_id = 'c0' AND token_id = 'c0-1'"))
    span = ("2024-01-05 00:00:00", "2024-01-06 00:00:00")
    ranged = trades.price_series(tables.trades, market="c0", span=span)
    assert rows(ranged) == rows(
        trades.price_series(tables.trades).filter("condition_id = 'c0' AND exchange_ts BETWEEN '2024-01-05' AND '2024-01-06'")
    )


def test_fan_out_of_market_versions(spark, tables):
    """Joining to the newest version keeps each trade once."""
    stats = markets.category_stats(tables.trades, tables.markets, tables.as_of, hours=24 * 31)
    assert stats.agg(F.sum("trade_count")).first()[0] == tables.trades.count()
    assert stats.filter("computed_category = ''").count() == 1


def test_health_on_empty_tables(spark, tables):
    empty = tables.trades.filter("false"), tables.levels.filter("false")
    assert {r.status for r in health.freshness(*empty, tables.as_of).collect()} == {"NO DATA"}
    row = health.token_coverage(*empty, tables.markets, tables.as_of).first()
    assert (row.recent_tokens, row.coverage) == (0, "low") and row.known_tokens > 0
    approx = health.token_coverage(tables.trades, tables.levels, tables.markets, tables.as_of, "30 DAYS", exact=False).first()
    exact = health.token_coverage(tables.trades, tables.levels, tables.markets, tables.as_of, "30 DAYS").first()
    assert approx.recent_tokens == pytest.approx(exact.recent_tokens, rel=0.05)


def test_running_sums_keep_null_keys_and_times(spark):
    data = [("a", 1, 5), ("a", None, 7), (None, 2, 11), (None, None, 13), (None, 2, 17), ("0", 3, 19)]
    df = spark.createDataFrame(data, "k string, s long, v long").selectExpr("k", "timestamp_seconds(s) AS ts", "v")
    w = W.partitionBy("k").orderBy("ts")
    plain = df.select("k", "ts", F.sum("v").over(w).cast("double").alias("c"))
    assert rows(running.cumulative(df, {"c": F.col("v")}, ["k"], "ts")) == rows(plain)
    w = W.partitionBy("k").orderBy("ts", "v").rowsBetween(W.unboundedPreceding, 0)
    plain = df.select("k", "ts", "v", F.sum("v").over(w).cast("double").alias("c"))
    assert rows(running.running_rows(df, {"c": F.col("v")}, ["k"], ["ts", "v"])) == rows(plain)
    plain = df.select("k", "ts", "v", F.row_number().over(W.partitionBy("k").orderBy("ts", "v")).cast("long").alias("position"))
    assert rows(running.positions(df, ["k"], ["ts", "v"])) == rows(plain)


def test_month_key_is_the_same_in_every_zone(spark):
    df = spark.createDataFrame([(1706745599,), (1706745600,), (-1,)], "s long").selectExpr("timestamp_seconds(s) AS ts")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r[0] for r in df.select(m.month_key("ts")).collect()] == ["202401", "202402", "196912"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_tokens_of_older_versions_are_not_forgotten(spark):
    versions = "market_id string, condition_id string, clob_token_ids array<string>, updated_at timestamp"
    df = spark.sql("SELECT 'm' AS market_id, 'c' AS condition_id, array('t1') AS clob_token_ids, timestamp '2024-01-01' AS updated_at "
                   "UNION ALL SELECT 'm', 'c2', array('t2'), timestamp '2024-01-02'")  # fmt: skip
    assert df.columns == [c.split()[0] for c in versions.split(", ")]
    found = {r.token_id: r.condition_id for r in dimension.token_map(df).collect()}
    assert found == {"t1": "c", "t2": "c2"}
