"""The read model, kept by a stream of change events.

Everything a batch writes goes to folders of its own before the batch counts as committed. A batch
that fails on the way is run again by Spark from its checkpoint and overwrites them, so each event
is projected once however often it is delivered or the job restarted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from packetflow import schemas
from packetflow.operators import changes, projection, stats
from packetflow.operators.joins import MAX_BROADCAST_KEYS
from packetflow.session import plain_caches, spread, together
from packetflow.sources.batches import (
    BatchTable,
    BucketedTable,
    CommitLog,
    FoldedTable,
    checkpoint_id,
)


def _told(parsed: DataFrame) -> tuple:
    """What one look at the parsed events of a batch tells.

    How many there are, are skipped and are of the wrong type, how many records have a clock, and the
    first and the last clock of records.
    """
    clock = F.when(F.col("skip_reason").isNull(), F.col("processed_ms"))
    bad = F.when(F.col("skip_reason") == "bad_type", 1)
    return parsed.agg(
        F.count("*"), F.count("skip_reason"), F.count(bad), F.count(clock), F.min(clock),
        F.max(clock),
    ).first()


@dataclass(frozen=True)
class ReadModel:
    """Tables below one folder: ledger, client state, statistics, markers, quarantine."""

    root: str
    ttl_ms: int = projection.MARKER_TTL_MS
    snapshot_every: int = 50
    ledger_buckets: int = 64
    ledger_every: int = 50

    @property
    def ledger(self) -> BucketedTable:
        # The bloom filter lets a lookup by id skip the row groups that do not hold it.
        bloom = {"parquet.bloom.filter.enabled#transaction_id": "true"}
        return BucketedTable.at(
            f"{self.root}/ledger", schemas.LEDGER, "transaction_id", self.ledger_every,
            self.ledger_buckets, options=bloom,
        )

    @property
    def client_state(self) -> FoldedTable:
        return FoldedTable.at(
            f"{self.root}/client_state",
            schemas.CLIENT_STATE,
            projection.fold_client_state,
            self.snapshot_every,
        )

    @property
    def stats(self) -> FoldedTable:
        return FoldedTable.at(
            f"{self.root}/stats", schemas.PROTOCOL_STATS, stats.merge_stats, self.snapshot_every
        )

    @property
    def markers(self) -> FoldedTable:
        return FoldedTable.at(
            f"{self.root}/markers", schemas.MARKERS, projection.fold_markers, self.snapshot_every
        )

    @property
    def quarantine(self) -> BatchTable:
        return BatchTable(f"{self.root}/quarantine", schemas.QUARANTINE)

    @property
    def outcomes(self) -> BatchTable:
        """How many events of each batch were skipped, projected or known."""
        return BatchTable(f"{self.root}/outcomes", "outcome STRING, events BIGINT")

    @property
    def commits(self) -> CommitLog:
        return CommitLog.at(f"{self.root}/commits")

    def create(self, spark: SparkSession) -> None:
        for table in (
            self.ledger, self.client_state, self.stats, self.markers, self.quarantine, self.outcomes,
            self.commits,
        ):
            table.create(spark)

    def project(self, batch: DataFrame, stream_batch: int, writer: str = "") -> None:
        """Project one micro-batch of change events; ``processed_ms`` is its clock.

        ``writer`` names the stream, whose batches are counted by ``stream_batch``; one that is
        finished already changes nothing. Only a count and the clock come back to the driver.
        """
        with plain_caches(batch.sparkSession):
            self._project(batch, stream_batch, writer)

    def _project(self, batch: DataFrame, stream_batch: int, writer: str) -> None:
        spark = batch.sparkSession
        state = self.commits.state(spark)
        batch_id = state.next_number(writer, stream_batch)
        if batch_id is None:
            return
        if "topic" not in batch.columns:
            batch = batch.withColumn("topic", F.lit(None).cast("string"))
        feed = spread(batch, "arrival_seq", "msg_partition")
        parsed = changes.parse_changes(feed).persist(StorageLevel.MEMORY_AND_DISK)
        records = changes.records(parsed)
        firsts = projection.first_arrivals(records)
        fresh = firsts
        try:
            events, skipped, bad, clocked, low, high = _told(parsed)
            known = events - skipped
            size = None
            if known > MAX_BROADCAST_KEYS and clocked == known and low == high:
                size, clock = records.select("transaction_id").distinct().count(), high
            if size is None or size <= MAX_BROADCAST_KEYS:
                firsts = firsts.persist(StorageLevel.MEMORY_AND_DISK)
                fresh = firsts
                size, clock = firsts.agg(F.count("*"), F.max("processed_ms")).first()
            # else they are looked at once only, for what passes the markers, and not kept
            clock = clock or 0
            # counted while they are written, not by another pass
            added, passed = Observation("added"), Observation("passed")
            # Any live marker stops a record, so markers are scanned as they lie, not folded.
            markers = self.markers.rows(spark, batch_id - 1)
            fresh = projection.fast_path(firsts, markers, clock, self.ttl_ms, size)
            fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)

            def store() -> None:
                new = fresh
                for part in self.ledger.parts(spark, batch_id - 1):
                    new = projection.new_ledger_rows(new, part, size)
                counted = changes.with_payload(new).observe(added, F.count("*").alias("n"))
                self.ledger.deltas.write(counted, batch_id)

            # without bad events nothing is looked through for them
            refused = changes.quarantined(parsed) if bad else parsed.filter(F.lit(False))
            together(spark, lambda: self.quarantine.write(refused, batch_id), store)
            written = self.ledger.only(spark, batch_id)
            winners = projection.client_winners(fresh)
            marks = fresh.select("transaction_id", F.lit(clock).alias("marked_at_ms"))
            marks = marks.observe(passed, F.count("*").alias("n"))
            alive = F.col("marked_at_ms") > F.lit(clock - self.ttl_ms)
            together(
                spark,
                lambda: self.stats.write(stats.protocol_stats(written), batch_id),
                lambda: self.client_state.write(
                    winners.withColumn("batch_no", F.lit(batch_id)), batch_id
                ),
                lambda: self.markers.write(marks, batch_id, keep=alive),
                lambda: self.ledger.merge(spark, batch_id),
            )
            counts = {
                projection.SKIPPED: skipped,
                projection.PROJECTED: added.get["n"],
                projection.DUPLICATE: passed.get["n"] - added.get["n"],
                projection.FAST_PATH_SKIP: events - skipped - passed.get["n"],
            }
            rows = [F.struct(F.lit(k), F.lit(n).cast("bigint")) for k, n in counts.items() if n]
            if rows:
                tally = spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))
                self.outcomes.write(tally.toDF("outcome", "events"), batch_id)
            self.commits.write(spark, state, writer, stream_batch, size)
        finally:
            for frame in (parsed, firsts, fresh):
                frame.unpersist()

    def start(
        self,
        feed: DataFrame,
        checkpoint: str,
        available_now: bool = True,
        interval: str = "1 minute",
    ) -> StreamingQuery:
        """Project a stream of change events.

        The clock is the time of the micro-batch. Spark keeps it in the checkpoint, so a replay
        sees the same one. Several checkpoints may write one after the other, in any order, and
        read what these tables hold already: their batches are numbered on from the last commit,
        so they meet the ledger of all before and change nothing twice.
        """
        spark = feed.sparkSession
        self.create(spark)
        writer_id = checkpoint_id(spark, checkpoint)
        clocked = feed
        if "processed_ms" not in feed.columns:
            clocked = feed.withColumn("processed_ms", F.unix_millis(F.current_timestamp()))

        def project(batch: DataFrame, batch_id: int) -> None:
            self.project(batch, batch_id, writer_id)

        writer = clocked.writeStream.foreachBatch(project).option("checkpointLocation", checkpoint)
        trigger = {"availableNow": True} if available_now else {"processingTime": interval}
        return writer.trigger(**trigger).start()

    def read_ledger(self, spark: SparkSession) -> DataFrame:
        return self.ledger.upto(spark, self.commits.last(spark))

    def read_client_state(self, spark: SparkSession) -> DataFrame:
        return self.client_state.current(spark, self.commits.last(spark))

    def read_stats(self, spark: SparkSession) -> DataFrame:
        return self.stats.current(spark, self.commits.last(spark))

    def read_outcomes(self, spark: SparkSession) -> DataFrame:
        return self.outcomes.upto(spark, self.commits.last(spark))

    def read_markers(self, spark: SparkSession) -> DataFrame:
        return self.markers.current(spark, self.commits.last(spark))
