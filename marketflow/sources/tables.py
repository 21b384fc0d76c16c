"""The stored tables: scans, appends, schema alignment, compaction.

Layout under a root folder: `<table>/event_month=<yyyyMM>/writer=<name>/batch_id=<n>/*.parquet` for the two fact
tables, the same without months for the versions of the dimension. Months come first, so that a time range lists only
its own folders. A batch is always written whole in overwrite mode, so a repeated batch replaces itself and no other.

Inside a batch rows are sorted by the columns that queries select by, in row groups of ROW_GROUP bytes, and the files
carry Bloom filters of the identifiers: a lookup of one market, token or trade skips the row groups without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions.metrics import latency_ms, moment, month_key
from marketflow.operators.dimension import latest_markets
from marketflow.operators.feed import SIDES
from marketflow.operators.rollups import minute_sketches, trade_minutes
from marketflow.schemas import DEFAULTS, ROLLUPS, TABLES
from marketflow.sources import folders

# Queries select by condition and token, so files are clustered by them and row-group statistics prune.
SORT_KEYS = {
    "trades_raw": ["condition_id", "token_id", "exchange_ts"],
    "orderbook_levels": ["condition_id", "token_id", "exchange_ts", "level"],
    "markets_dim": ["condition_id", "market_id"],
    "trade_minutes": ["condition_id", "token_id", "minute"],
    "minute_sketches": ["minute"],
}
# Equality lookups that sorting alone does not serve; the writer chooses the size of each filter.
BLOOM = {
    "trades_raw": ["condition_id", "token_id", "trade_id"],
    "orderbook_levels": ["condition_id", "token_id"],
    "markets_dim": ["condition_id", "market_id"],
    "trade_minutes": ["condition_id", "token_id"],
    "minute_sketches": [],
}
ROW_GROUP = 32 * 1024 * 1024
COMPACT = "compact"  # writer name of compacted batches


def stored_schema(table: str) -> T.StructType:
    partitions = [T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())]
    if table != "markets_dim":
        partitions.insert(0, T.StructField("event_month", T.StringType()))
    return T.StructType([*(TABLES | ROLLUPS)[table].fields, *partitions])


def months_between(spark: SparkSession, root: str, table: str, lo=None, hi=None) -> list[str]:
    """The months of a table that a closed time range can touch, from one listing of its folder."""
    low, high = (None if t is None else month_key(moment(t)) for t in (lo, hi))
    bounds = spark.range(1).select(*[F.lit("") if b is None else b for b in (low, high)]).first()
    found = [name.removeprefix("event_month=") for name in folders.children(spark, f"{root}/{table}") if name.startswith("event_month=")]
    return [m for m in found if not m.isdigit() or ((low is None or m >= bounds[0]) and (high is None or m <= bounds[1]))]


def load(spark: SparkSession, root: str, table: str, span: tuple | None = None) -> DataFrame:
    """Scan of a stored table with its partition columns; nothing is inferred from the files.

    With `span`, a pair of times (or None), only the folders of its months are listed; rows outside the range but in
    these months are not cut. Rows without a month are always read.
    """
    reader = spark.read.schema(stored_schema(table))
    if span is None or table == "markets_dim":
        return reader.parquet(f"{root}/{table}")
    months = months_between(spark, root, table, *span)
    if not months:
        return spark.createDataFrame([], stored_schema(table))
    return reader.option("basePath", f"{root}/{table}").parquet(*[f"{root}/{table}/event_month={m}" for m in months])


def load_stream(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The same table as a stream of newly written files, without those that a compaction wrote anew."""
    rows = spark.readStream.schema(stored_schema(table)).parquet(f"{root}/{table}")
    return rows.filter(F.col("writer") != COMPACT)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def _default(value, kind: T.DataType) -> Column:
    return F.array().cast(kind) if isinstance(kind, T.ArrayType) else F.lit(value).cast(kind)


def align_schema(df: DataFrame, table: str) -> DataFrame:
    """Columns of the table in order and type; missing columns and nulls take the defaults."""
    defaults, columns = DEFAULTS[table], []
    for field in TABLES[table].fields:
        col = F.col(field.name).cast(field.dataType) if field.name in df.columns else F.lit(None).cast(field.dataType)
        if field.name in defaults:
            col = F.coalesce(col, _default(defaults[field.name], field.dataType))
        columns.append(col.alias(field.name))
    return df.select(*columns)


def _write(df: DataFrame, root: str, table: str, writer: str, batch_id: int, cluster: bool, row_group: int = ROW_GROUP) -> None:
    spark, keys = df.sparkSession, SORT_KEYS[table]
    months = [] if table == "markets_dim" else ["event_month"]
    if months:
        df = df.withColumn("event_month", month_key("minute" if table in ROLLUPS else "exchange_ts"))
    if cluster:
        # A range split cuts a hot token by time, so no task writes it alone.
        df = df.repartitionByRange(*months, *keys)
    written = Observation()
    rows = df.sortWithinPartitions(*months, *keys)
    if months:
        rows = rows.observe(written, F.collect_set("event_month").alias("months"))
        rows = rows.withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("long")})
    options = {"parquet.block.size": row_group, "parquet.bloom.filter.adaptive.enabled": "true"}
    options |= {f"parquet.bloom.filter.enabled#{c}": "true" for c in BLOOM[table]}
    out = rows.write.mode("overwrite").options(**options)
    if not months:
        out.parquet(f"{root}/{table}/writer={writer}/batch_id={batch_id}")
        return
    out.partitionBy("event_month", "writer", "batch_id").option("partitionOverwriteMode", "dynamic").parquet(f"{root}/{table}")
    # A batch that is repeated with other rows may no longer have a month that it had before.
    kept = {f"event_month={m}" for m in written.get["months"]}
    for name in folders.children(spark, f"{root}/{table}"):
        if name.startswith("event_month=") and name not in kept and name[12:].isdigit():
            folders.remove(spark, f"{root}/{table}/{name}/writer={writer}/batch_id={batch_id}")


def prepare_trades(df: DataFrame) -> DataFrame:
    local = F.coalesce("local_ts", F.current_timestamp()) if "local_ts" in df.columns else F.current_timestamp()
    rows = df.withColumn("local_ts", local)
    return align_schema(rows.withColumn("delta_t_ms", latency_ms(F.col("exchange_ts"), F.col("local_ts"))), "trades_raw")


def prepare_levels(df: DataFrame) -> DataFrame:
    """Rows with all four values null are dropped."""
    local = F.coalesce("local_ts", F.current_timestamp()) if "local_ts" in df.columns else F.current_timestamp()
    kept = df.filter(F.coalesce("bid_px", "bid_sz", "ask_px", "ask_sz").isNotNull())
    return align_schema(kept.withColumn("local_ts", local), "orderbook_levels")


def _unfit() -> Column:
    return F.col("exchange_ts").isNull() | F.col("side").isNull() | ~F.col("side").isin(*SIDES)


def write_trades(df: DataFrame, root: str, writer: str = "load", batch_id: int = 0, cluster: bool = True) -> None:
    """Rows without a time or with a side outside the domain go to `rejected_trades`, under the same batch."""
    seen, rows, unfit = Observation(), prepare_trades(df), _unfit()
    counted = rows.observe(seen, F.count_if(unfit).alias("unfit"))
    _write(counted.filter(~unfit), root, "trades_raw", writer, batch_id, cluster)
    if seen.get["unfit"]:
        bad = rows.filter(unfit).write.mode("overwrite")
        bad.parquet(f"{root}/rejected_trades/writer={writer}/batch_id={batch_id}")


def write_levels(df: DataFrame, root: str, writer: str = "load", batch_id: int = 0, cluster: bool = True) -> None:
    _write(prepare_levels(df), root, "orderbook_levels", writer, batch_id, cluster)


def write_rollups(trades: DataFrame, levels: DataFrame, root: str, writer: str = "load", batch_id: int = 0) -> None:
    """The partial rows per minute of what `write_trades` and `write_levels` store of a batch, under the same batch."""
    trades, levels = prepare_trades(trades).filter(~_unfit()), prepare_levels(levels)
    minutes = trade_minutes(trades).select(*[F.col(f.name).cast(f.dataType) for f in ROLLUPS["trade_minutes"].fields])
    _write(minutes, root, "trade_minutes", writer, batch_id, cluster=False)
    sketches = minute_sketches(trades, "trades_raw").unionByName(minute_sketches(levels, "orderbook_levels"))
    _write(sketches, root, "minute_sketches", writer, batch_id, cluster=False)


def write_markets(df: DataFrame, root: str, now=None, writer: str = "load", batch_id: int = 0) -> None:
    """Append one version per market; all rows of the batch get the same `updated_at`."""
    versions = align_schema(df.withColumn("updated_at", moment(now)), "markets_dim")
    _write(versions, root, "markets_dim", writer, batch_id, cluster=False)


def compact_markets(df: DataFrame) -> DataFrame:
    """Only the newest version of every market."""
    return latest_markets(df).select(*TABLES["markets_dim"].names)


def compact(spark: SparkSession, root: str, target: str, table: str) -> None:
    """Rewrite a table of many small batches, clustered, under another root; the dimension keeps only its newest versions."""
    if target.rstrip("/") == root.rstrip("/"):
        raise ValueError("compact into another root than the one that is read")
    rows = load(spark, root, table).select(*TABLES[table].names)
    if table == "markets_dim":
        rows = compact_markets(rows)
    _write(rows, target, table, COMPACT, 0, cluster=True)


def compact_month(spark: SparkSession, root: str, table: str, month: str) -> int:
    """Merge the batches of one month of a fact table into one clustered batch, in place; the number of batches merged.

    The newest batch of every writer stays as it is: a stream repeats its last batch after a failure, and the repeated
    batch must find its own folder. The merged rows are written aside first, then the list of their sources; from then on
    `finish_compaction` can end the work, also after a crash. Run it while no query lists the month: between the move and
    the removal of the sources a new listing would see the rows twice.
    """
    finish_compaction(spark, root, table)
    base = f"{root}/{table}/event_month={month}"
    found = {w: [int(b.removeprefix("batch_id=")) for b in folders.children(spark, f"{base}/{w}")] for w in folders.children(spark, base)}
    own = f"writer={COMPACT}"
    sources = [f"{base}/{w}/batch_id={b}" for w, batches in found.items() for b in batches if w == own or b < max(batches)]
    if len(sources) < 2:
        return 0
    aside = f"{root}/{table}/_compacting/event_month={month}"
    rows = spark.read.schema(TABLES[table]).parquet(*sources)
    number = max(found.get(own, []), default=-1) + 1
    _write(rows, f"{aside}/rows", table, COMPACT, number, cluster=True)
    spark.createDataFrame([(s,) for s in sources], "source string").coalesce(1).write.mode("overwrite").parquet(f"{aside}/sources")
    finish_compaction(spark, root, table)
    return len(sources)


def finish_compaction(spark: SparkSession, root: str, table: str) -> None:
    """End what `compact_month` has begun: move the merged rows to their place and remove their sources, or, if the list
    of sources was not written, remove what lies aside."""
    for month in folders.children(spark, f"{root}/{table}/_compacting"):
        aside = f"{root}/{table}/_compacting/{month}"
        if folders.exists(spark, f"{aside}/sources/_SUCCESS"):
            merged = f"{aside}/rows/{table}/{month}/writer={COMPACT}"
            for batch in folders.children(spark, merged):
                folders.move(spark, f"{merged}/{batch}", f"{root}/{table}/{month}/writer={COMPACT}/{batch}")
            for row in spark.read.parquet(f"{aside}/sources").collect():
                folders.remove(spark, row.source)
        folders.remove(spark, aside)
