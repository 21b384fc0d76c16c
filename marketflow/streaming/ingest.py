"""Continuous ingest: feed messages → trades and book levels, enriched from the market dimension."""

from __future__ import annotations

import logging
import threading
import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from marketflow.operators.dimension import enrich
from marketflow.operators.feed import classify, normalize_trades, parse_books, unfold_levels
from marketflow.operators.joins import fits_broadcast
from marketflow.sources.messages import read_messages
from marketflow.sources.snapshots import newest_tokens
from marketflow.sources.tables import write_levels, write_rollups, write_trades

log = logging.getLogger(__name__)

REPORT_SECONDS = 10


@dataclass
class IngestConfig:
    source: str
    root: str
    checkpoint: str
    fmt: str = "text"
    options: dict = field(default_factory=dict)
    flush: str = "1 second"
    sync_seconds: int = 300
    rollups: bool = True
    available_now: bool = False


class IngestStats(StreamingQueryListener):
    """Received and written counts; a line is logged at most every ten seconds."""

    def __init__(self) -> None:
        self.query_id: str | None = None  # set when the query has started; other queries are not counted
        self._early: dict[str, list] = {}
        self.totals = dict.fromkeys(
            ("events_received", "trades_received", "books_received", "trades_written", "levels_written", "rejected"), 0
        )
        self._lock = threading.Lock()
        self._reported = 0.0

    def add(self, counts: dict) -> None:
        with self._lock:
            for name, n in counts.items():
                self.totals[name] += n or 0

    def _received(self, query_id: str, counts: dict) -> None:
        if self.query_id is None:
            self._early.setdefault(query_id, []).append(counts)
        elif query_id == self.query_id:
            self.add(counts)

    def follow(self, query_id: str) -> None:
        """Count this query only, with the batches it may have finished already."""
        self.query_id = query_id
        for counts in self._early.pop(query_id, []):
            self.add(counts)
        self._early.clear()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        received = event.progress.observedMetrics.get("received")
        if received is not None:
            self._received(str(event.progress.id), received.asDict())
        if time.monotonic() - self._reported >= REPORT_SECONDS:
            self._reported = time.monotonic()
            log.info("ingest %s", self.totals)

    def onQueryTerminated(self, event) -> None:
        pass


def refresh_dimension(spark: SparkSession, root: str) -> DataFrame | None:
    """Token map of the newest market versions, from the snapshot and the versions that came since; None before the first sync."""
    return newest_tokens(spark, root)


class _Batches:
    """Writes one micro-batch: trades, levels and rejected events from one parse."""

    def __init__(self, cfg: IngestConfig, stats: IngestStats):
        self.cfg, self.stats = cfg, stats
        self.writer = threading.Event()
        self.writer_id = ""
        self._tokens: DataFrame | None = None
        self._small = True
        self._synced = float("-inf")

    def _dimension(self, spark: SparkSession) -> DataFrame | None:
        if time.monotonic() - self._synced >= self.cfg.sync_seconds:
            self._tokens = refresh_dimension(spark, self.cfg.root)
            self._small = self._tokens is not None and fits_broadcast(self._tokens)
            self._synced = time.monotonic()
        return self._tokens

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.writer.wait()
        spark, cfg = batch.sparkSession, self.cfg
        tokens = self._dimension(spark)

        def enriched(rows: DataFrame) -> DataFrame:
            return rows if tokens is None else enrich(rows, tokens, small=self._small)

        events = batch.persist(StorageLevel.MEMORY_AND_DISK)
        books = parse_books(events.filter(F.col("kind") == "book")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            trades = normalize_trades(events.filter(F.col("kind") == "trade"))
            good_trades = enriched(trades.filter(F.col("reject").isNull()).drop("event", "reject"))
            good_levels = enriched(unfold_levels(books))
            bad = (
                trades.select("local_ts", "reject", F.to_json("event").alias("event"))
                .unionByName(books.select("local_ts", "reject", F.to_json("event").alias("event")))
                .filter(F.col("reject").isNotNull())
            )
            counted = {name: Observation() for name in ("trades_written", "levels_written", "rejected")}

            def observed(rows: DataFrame, name: str) -> DataFrame:
                return rows.observe(counted[name], F.count(F.lit(1)).alias(name))

            write_trades(observed(good_trades, "trades_written"), cfg.root, self.writer_id, batch_id, cluster=False)
            write_levels(observed(good_levels, "levels_written"), cfg.root, self.writer_id, batch_id, cluster=False)
            if cfg.rollups:
                write_rollups(good_trades, good_levels, cfg.root, self.writer_id, batch_id)
            observed(bad, "rejected").write.mode("overwrite").parquet(
                f"{cfg.root}/rejected_events/writer={self.writer_id}/batch_id={batch_id}"
            )
            for observation in counted.values():
                self.stats.add(observation.get)
        finally:
            books.unpersist()
            events.unpersist()


def start_ingest(spark: SparkSession, cfg: IngestConfig, stats: IngestStats | None = None) -> StreamingQuery:
    """Start the ingest query.

    Every batch is written under the query's id and the batch id in overwrite mode: a batch that is repeated
    after a failure replaces its own files, and another query over the same root cannot replace them.
    """
    stats = stats or IngestStats()
    spark.streams.addListener(stats)
    events = classify(read_messages(spark, cfg.source, streaming=True, fmt=cfg.fmt, **cfg.options)).observe(
        "received",
        F.count(F.lit(1)).alias("events_received"),
        F.count_if(F.col("kind") == "trade").alias("trades_received"),
        F.count_if(F.col("kind") == "book").alias("books_received"),
    )
    batches = _Batches(cfg, stats)
    writer = events.writeStream.foreachBatch(batches).option("checkpointLocation", cfg.checkpoint)
    writer = writer.trigger(availableNow=True) if cfg.available_now else writer.trigger(processingTime=cfg.flush)
    query = writer.start()
    stats.follow(str(query.id))
    batches.writer_id = str(query.id)
    batches.writer.set()
    return query
