"""Bucketed tables: the same rows, and no exchange below the join to the dimension."""

import pytest

from marketflow.plans import markets as q
from marketflow.sources import catalog
from tests.conftest import rows


@pytest.fixture
def saved(spark, tables):
    names = {"trades_raw": tables.trades, "markets_dim": tables.markets}
    try:
        for table, df in names.items():
            catalog.save_bucketed(df, f"bucketed_{table}", table, 4)
        yield [catalog.bucketed(spark, f"bucketed_{t}") for t in names]
    finally:
        for table in names:
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{table}")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_category_stats_without_a_shuffle_below_the_join(spark, tables, saved):
    trades, markets = saved
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = q.category_stats(trades, markets, tables.as_of, hours=720)
        plan = plan_of(found)
        below = plan[plan.index("Join") :]
        assert "Exchange" not in below and "Exchange" in plan[: plan.index("Join")]
        assert "Bucketed: true" in below
        plain = plan_of(q.category_stats(tables.trades, tables.markets, tables.as_of, hours=720))
        assert "Exchange" in plain[plain.index("Join") :]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert rows(found) == rows(q.category_stats(tables.trades, tables.markets, tables.as_of, hours=720))


def test_saving_again_replaces(spark, tables, saved):
    catalog.save_bucketed(tables.trades.limit(10), "bucketed_trades_raw", "trades_raw", 2)
    assert catalog.bucketed(spark, "bucketed_trades_raw").count() == 10


def test_bucket_counts():
    mb = 1024 * 1024
    assert [catalog.bucket_count(s * mb) for s in (0, 1, 256, 257, 1000, 10**6)] == [1, 1, 1, 2, 4, 4096]
