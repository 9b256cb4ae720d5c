"""Streams that keep state from batch to batch: seen transactions, live statistics, rate limits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from packetflow import schemas
from packetflow.operators import admission, changes, projection, stats
from packetflow.operators.ranking import best_per_key
from packetflow.session import shared_dir
from packetflow.sources.batches import (
    BatchTable,
    BucketedTable,
    CommitLog,
    FoldedTable,
    checkpoint_id,
)

#: How long the state of the stream remembers a transaction, at least until its window ends, and how
#: much later than the newest clock a window is given up.
SEEN_WINDOW, SEEN_DELAY = "7 days", "1 day"


def _started(stream: DataFrame, run, checkpoint: str, mode: str, available_now: bool):
    writer = stream.writeStream.outputMode(mode).foreachBatch(run)
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start()


def first_seen(
    records: DataFrame, window: str = SEEN_WINDOW, delay: str = SEEN_DELAY
) -> DataFrame:
    """Of a stream of records: each transaction's first in its window, and when it was seen.

    ``processed_ms`` is the clock of the micro-batch, the same for all its rows, so no row is behind
    the watermark and none is dropped, however late its event is. The state holds one record for
    each transaction and window and is an aggregate, which every task combines before it sends:
    a transaction with a third of all rows is no task's burden. A batch gives the transactions it
    met; those it met for the first time have ``since = latest``.
    """
    order = [c for c in ("arrival_seq", *projection.TIES) if c in records.columns]
    columns = [c for c in records.columns if c != "processed_ms"]
    arrived = records.withColumn("arrived", F.timestamp_millis("processed_ms"))
    first = F.min_by(F.struct(*columns), F.struct(*order))
    return (
        arrived.withWatermark("arrived", delay)
        .groupBy(F.window("arrived", window), "transaction_id")
        .agg(first.alias("first"), F.min("arrived").alias("since"), F.max("arrived").alias("latest"))
    )


@dataclass(frozen=True)
class SeenLedger:
    """A ledger behind a filter in the state of the stream.

    The state stops what it has seen, at no look at any table; what gets past it, because it is new
    or its window has ended, meets the ledger, which is exact. So the ledger is the same as without
    the filter.
    """

    root: str
    window: str = SEEN_WINDOW
    delay: str = SEEN_DELAY
    ledger_buckets: int = 64
    ledger_every: int = 50

    @property
    def ledger(self) -> BucketedTable:
        return BucketedTable.at(
            f"{self.root}/ledger", schemas.LEDGER, "transaction_id", self.ledger_every,
            self.ledger_buckets,
        )

    @property
    def commits(self) -> CommitLog:
        return CommitLog.at(f"{self.root}/commits")

    def start(
        self, feed: DataFrame, checkpoint: str, available_now: bool = True
    ) -> StreamingQuery:
        """Store a stream of change events with their clock ``processed_ms``."""
        spark = feed.sparkSession
        self.ledger.create(spark)
        self.commits.create(spark)
        writer_id = checkpoint_id(spark, checkpoint)
        records = changes.records(changes.parse_changes(feed))

        def store(batch: DataFrame, stream_batch: int) -> None:
            session = batch.sparkSession
            state = self.commits.state(session)
            number = state.next_number(writer_id, stream_batch)
            if number is None:
                return
            # written once, so that no later look at it runs the state of the stream again
            shared_dir(session)
            new = batch.filter("since = latest").select("first.*").checkpoint()
            size = new.count()
            fresh = new
            for part in self.ledger.parts(session, number - 1):
                fresh = projection.new_ledger_rows(fresh, part, size)
            self.ledger.write(changes.with_payload(fresh), number)
            self.commits.write(session, state, writer_id, stream_batch, size)

        seen = first_seen(records, self.window, self.delay)
        return _started(seen, store, checkpoint, "update", available_now)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.ledger.upto(spark, self.commits.last(spark))


@dataclass(frozen=True)
class LiveStats:
    """Statistics per protocol kept in the state of a stream of ledger rows.

    Every batch writes the protocols that changed, with their totals; written again, it writes the
    same. The statistics after any batch are the latest row of each protocol. A new checkpoint counts
    from nothing: it needs a folder of its own.
    """

    root: str

    @property
    def changed(self) -> BatchTable:
        return BatchTable(f"{self.root}/changed", schemas.PROTOCOL_STATS)

    @property
    def commits(self) -> CommitLog:
        return CommitLog.at(f"{self.root}/commits")

    def start(
        self, ledger: DataFrame, checkpoint: str, available_now: bool = True
    ) -> StreamingQuery:
        spark = ledger.sparkSession
        self.changed.create(spark)
        self.commits.create(spark)
        writer_id = checkpoint_id(spark, checkpoint)
        if self.commits.state(spark).others(writer_id):
            raise ValueError(f"{self.root} belongs to another checkpoint")

        def upsert(batch: DataFrame, stream_batch: int) -> None:
            session = batch.sparkSession
            state = self.commits.state(session)
            number = state.next_number(writer_id, stream_batch)
            if number is not None:
                self.changed.write(batch, number)
                self.commits.write(session, state, writer_id, stream_batch, 0)

        return _started(stats.protocol_stats(ledger), upsert, checkpoint, "update", available_now)

    def read(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The statistics after a batch, by default the last finished one."""
        last = self.commits.last(spark) if upto is None else upto
        rows = self.changed.upto(spark, last)
        return best_per_key(rows, ["proto"], [F.col("batch_id").desc()]).drop("batch_id")


USED = "caller STRING, window_start_ms BIGINT, used BIGINT"
DECIDED = "call_id BIGINT, caller STRING, window_start_ms BIGINT, ts_ms BIGINT, admitted INT"


@dataclass(frozen=True)
class Admission:
    """Rate limits over a stream of calls: the permits of a window are carried from batch to batch.

    Calls come in the order of their times from batch to batch, as a gateway sees them. The state is
    the number of permits used for each caller and window; windows that ended more than ``late_ms``
    before the newest call are forgotten when a snapshot is written, and calls for them are refused.
    """

    root: str
    permits: int = admission.PERMITS
    window_ms: int = admission.WINDOW_MS
    late_ms: int = 24 * 3600 * 1000
    snapshot_every: int = 50

    @property
    def used(self) -> FoldedTable:
        def fold(rows: DataFrame) -> DataFrame:
            return rows.groupBy("caller", "window_start_ms").agg(F.sum("used").alias("used"))

        return FoldedTable.at(f"{self.root}/used", USED, fold, self.snapshot_every)

    @property
    def decided(self) -> BatchTable:
        return BatchTable(f"{self.root}/decided", DECIDED)

    @property
    def commits(self) -> CommitLog:
        return CommitLog.at(f"{self.root}/commits")

    def decide(self, batch: DataFrame, stream_batch: int, writer: str = "") -> None:
        """Decide one micro-batch of calls; the newest window start comes to the driver."""
        spark = batch.sparkSession
        state = self.commits.state(spark)
        number = state.next_number(writer, stream_batch)
        if number is None:
            return
        calls = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            used = self.used.current(spark, number - 1)
            before = used.agg(F.max("window_start_ms")).first()[0]
            decided = admission.fixed_window_admission(calls, self.permits, self.window_ms, used)
            if before is not None:
                ended = F.col("window_start_ms") + self.window_ms + self.late_ms < before
                decided = decided.withColumn(
                    "admitted", F.when(ended, F.lit(0)).otherwise(F.col("admitted"))
                )
            self.decided.write(decided, number)
            written = self.decided.only(spark, number)
            delta = (
                written.filter("admitted = 1").groupBy("caller", "window_start_ms")
                .agg(F.count("*").alias("used"))
            )
            newest = written.agg(F.max("window_start_ms")).first()[0]
            newest = max((x for x in (before, newest) if x is not None), default=0)
            alive = F.col("window_start_ms") + self.window_ms + self.late_ms >= newest
            self.used.write(delta, number, keep=alive)
            self.commits.write(spark, state, writer, stream_batch, 0)
        finally:
            calls.unpersist()

    def start(
        self, calls: DataFrame, checkpoint: str, available_now: bool = True
    ) -> StreamingQuery:
        spark = calls.sparkSession
        for table in (self.used, self.decided, self.commits):
            table.create(spark)
        writer_id = checkpoint_id(spark, checkpoint)

        def decide(batch: DataFrame, stream_batch: int) -> None:
            self.decide(batch, stream_batch, writer_id)

        return _started(calls, decide, checkpoint, "append", available_now)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.decided.upto(spark, self.commits.last(spark)).drop("batch_id")
