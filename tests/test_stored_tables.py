"""The stored layout: months, row groups, compaction in place, and the snapshot of the newest market versions."""

import random

import pytest
from pyspark.sql import functions as F

from marketflow.operators.dimension import latest_markets, token_map
from marketflow.operators.filters import lookback
from marketflow.schemas import TABLES
from marketflow.sources import folders, snapshots, tables
from tests.conftest import rows


def trades_of(spark, n, days=1, start="2024-01-31 00:00:00"):
    return spark.range(n).select(
        F.expr(f"timestamp'{start}' + make_interval(0, 0, 0, cast(id % {days} as int))").alias("exchange_ts"),
        F.format_string("c%05d", F.col("id") % 997).alias("condition_id"),
        F.format_string("t%06d", (F.col("id") * 7919) % 10007).alias("token_id"),
        F.concat(F.lit("id"), F.xxhash64("id").cast("string")).alias("trade_id"),
        F.lit("BUY").alias("side"), F.lit(0.5).alias("price"), F.lit(1.0).alias("size"),
    )


def rows_scanned(df):
    """Rows that left the scan, after the row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_skips_row_groups(spark, tmp_path):
    df = tables.prepare_trades(trades_of(spark, 200_000))
    tables._write(df, str(tmp_path), "trades_raw", "w", 0, cluster=True, row_group=256 * 1024)
    stored = tables.load(spark, str(tmp_path), "trades_raw")
    assert stored.count() == 200_000
    some = stored.limit(1).first()
    for column in ("condition_id", "token_id", "trade_id"):  # the last two do not follow the order of the files
        found = stored.filter(F.col(column) == some[column]).select("price", column)
        assert found.count() == df.filter(F.col(column) == some[column]).count() > 0
        assert rows_scanned(found) < 100_000, column
    assert rows_scanned(stored.filter("trade_id = 'id1x'").select("price")) < 20_000


def test_a_range_lists_only_its_months(spark, tmp_path):
    root = str(tmp_path)
    tables.write_trades(trades_of(spark, 400, days=120), root)
    assert folders.children(spark, f"{root}/trades_raw") == [f"event_month=2024{m:02}" for m in range(1, 6)]
    part = tables.load(spark, root, "trades_raw", span=("2024-02-10 00:00:00", "2024-03-01 00:00:00"))
    months = {f.split("event_month=")[1][:6] for f in part.inputFiles()}
    assert months == {"202402", "202403"} and set(part.columns) == set(tables.load(spark, root, "trades_raw").columns)
    whole = tables.load(spark, root, "trades_raw")
    after = "exchange_ts >= '2024-04-20'"
    assert tables.load(spark, root, "trades_raw", span=("2024-04-20 00:00:00", None)).filter(after).count() == whole.filter(after).count() > 0
    assert tables.load(spark, root, "trades_raw", span=("2025-01-01 00:00:00", None)).count() == 0
    assert lookback(part, "2024-03-01 00:00:00", "5 DAYS").filter("exchange_ts <= '2024-03-01'").count() > 0


def test_a_repeated_batch_leaves_no_month_behind(spark, tmp_path):
    root = str(tmp_path)
    tables.write_trades(trades_of(spark, 90, days=60), root, "w", 3)
    tables.write_trades(trades_of(spark, 7), root, "w", 2)
    tables.write_trades(trades_of(spark, 10), root, "w", 3)
    found = tables.load(spark, root, "trades_raw")
    assert rows(found.groupBy("event_month", "batch_id").count()) == [("202401", 2, 7), ("202401", 3, 10)]


def month_of(spark, root):
    return tables.load(spark, root, "trades_raw", span=("2024-01-01 00:00:00", "2024-01-31 23:00:00"))


def test_compaction_in_place(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(4):
        tables.write_trades(trades_of(spark, 50 + batch, days=2), root, "w", batch, cluster=False)
    tables.write_trades(trades_of(spark, 5), root, "other", 9)
    before, columns = tables.load(spark, root, "trades_raw"), TABLES["trades_raw"].names
    want, other = rows(before, *[c for c in columns if c != "local_ts"]), rows(before.filter("event_month = '202402'"), "trade_id")
    assert tables.compact_month(spark, root, "trades_raw", "202401") == 3
    after = tables.load(spark, root, "trades_raw")
    assert rows(after, *[c for c in columns if c != "local_ts"]) == want
    assert rows(after.filter("event_month = '202402'"), "trade_id") == other
    assert rows(month_of(spark, root).select("writer", "batch_id").distinct()) == [("compact", 0), ("other", 9), ("w", 3)]
    # The last batch can still be repeated, and the next compaction takes the merged rows along.
    tables.write_trades(trades_of(spark, 53, days=2), root, "w", 3, cluster=False)
    tables.write_trades(trades_of(spark, 1), root, "w", 4)
    assert tables.compact_month(spark, root, "trades_raw", "202401") == 2
    assert month_of(spark, root).count() == len([r for r in want if r[0].month == 1]) + 1
    assert tables.compact_month(spark, root, "trades_raw", "202401") == 0
    stream = tables.load_stream(spark, root, "trades_raw").select("trade_id")
    query = stream.writeStream.format("memory").queryName("not_compacted").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("not_compacted").count() == tables.load(spark, root, "trades_raw").filter("writer <> 'compact'").count()


@pytest.mark.parametrize("listed", [True, False])
def test_a_compaction_that_broke_off(spark, tmp_path, monkeypatch, listed):
    root = str(tmp_path)
    for batch in range(3):
        tables.write_trades(trades_of(spark, 20), root, "w", batch)
    with monkeypatch.context() as m:
        m.setattr(tables, "finish_compaction", lambda *a: None)
        tables.compact_month(spark, root, "trades_raw", "202401")
    assert tables.load(spark, root, "trades_raw").count() == 60  # what lies aside is not read
    if not listed:
        folders.remove(spark, f"{root}/trades_raw/_compacting/event_month=202401/sources/_SUCCESS")
    tables.finish_compaction(spark, root, "trades_raw")
    assert tables.load(spark, root, "trades_raw").count() == 60
    assert not folders.exists(spark, f"{root}/trades_raw/_compacting/event_month=202401")
    assert len(folders.children(spark, f"{root}/trades_raw/event_month=202401")) == (2 if listed else 1)


def versions(spark, rng, n, markets=40):
    out = [(f"m{k}", f"c{k}", rng.sample([f"t{i}" for i in range(60)], rng.randint(0, 3)), f"q{rng.random()}") for k in rng.sample(range(markets), n)]
    return spark.createDataFrame(out, "market_id string, condition_id string, clob_token_ids array<string>, question string")


def test_snapshot_equals_all_versions(spark, tmp_path, monkeypatch):
    root, rng = str(tmp_path), random.Random(3)
    assert snapshots.newest_markets(spark, root) is None
    read = []
    plain_read = snapshots._read
    monkeypatch.setattr(snapshots, "_read", lambda *a: read.append(a[2:]) or plain_read(*a))
    for batch, (n, now) in enumerate(((30, "2024-01-05"), (3, "2024-01-06"), (5, "2024-01-04"), (40, "2024-01-06"))):
        tables.write_markets(versions(spark, rng, n), root, now=f"{now} 00:00:00", batch_id=batch)
        found, stored = snapshots.newest_markets(spark, root), tables.load(spark, root, "markets_dim")
        names = TABLES["markets_dim"].names
        assert rows(found, *names) == rows(latest_markets(stored.select(*names)), *names)
        assert rows(snapshots.newest_tokens(spark, root), "token_id", "condition_id", "market_id") == rows(token_map(stored), "token_id", "condition_id", "market_id")
    assert read.count((2, "files")) > 1 and (0, "markets") in read
    assert folders.children(spark, f"{root}/markets_snapshot") == ["generation=2", "generation=3"]


def test_a_refresh_reads_the_snapshot_and_what_is_new(spark, tmp_path, monkeypatch):
    root, rng = str(tmp_path), random.Random(4)
    for batch in range(3):
        tables.write_markets(versions(spark, rng, 20), root, now=f"2024-01-0{batch + 1} 00:00:00", batch_id=batch)
    assert snapshots.refresh(spark, root) == 0
    tables.write_markets(versions(spark, rng, 1), root, now="2024-01-09 00:00:00", batch_id=3)
    merged = []
    plain_merge = snapshots.merged_latest
    monkeypatch.setattr(snapshots, "merged_latest", lambda *a: merged.append(plain_merge(*a)) or merged[-1])
    assert snapshots.refresh(spark, root) == 1 and len(merged) == 2
    for df in merged:
        files = df.inputFiles()
        assert files and all("generation=0" in f or "batch_id=3" in f for f in files)
    assert snapshots.refresh(spark, root) == 1 and len(merged) == 2  # nothing new


def test_a_repeated_version_batch_is_taken_back(spark, tmp_path):
    root, rng = str(tmp_path), random.Random(5)
    tables.write_markets(versions(spark, rng, 20), root, now="2024-01-01 00:00:00", batch_id=0)
    tables.write_markets(versions(spark, rng, 20), root, now="2024-01-03 00:00:00", batch_id=1)
    snapshots.refresh(spark, root)
    tables.write_markets(versions(spark, rng, 5), root, now="2024-01-02 00:00:00", batch_id=1)
    stored = tables.load(spark, root, "markets_dim").select(*TABLES["markets_dim"].names)
    assert rows(snapshots.newest_markets(spark, root), "market_id", "question") == rows(latest_markets(stored), "market_id", "question")


def test_a_refresh_that_broke_off_does_not_count(spark, tmp_path):
    root, rng = str(tmp_path), random.Random(6)
    tables.write_markets(versions(spark, rng, 10), root, now="2024-01-01 00:00:00", batch_id=0)
    snapshots.refresh(spark, root)
    tables.write_markets(versions(spark, rng, 10), root, now="2024-01-02 00:00:00", batch_id=1)
    snapshots.refresh(spark, root)
    folders.remove(spark, f"{root}/markets_snapshot/generation=1/files/_SUCCESS")
    stored = tables.load(spark, root, "markets_dim").select(*TABLES["markets_dim"].names)
    assert rows(snapshots.newest_markets(spark, root), "market_id", "question") == rows(latest_markets(stored), "market_id", "question")
    assert snapshots._generations(spark, root) == [0, 1]
