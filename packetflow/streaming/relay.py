"""The relay: a stream over new outbox rows, or ticks over an outbox stored with its claims."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from packetflow import schemas
from packetflow.functions import hash_slot, is_blank
from packetflow.operators import outbox as ob
from packetflow.operators.joins import without_stored
from packetflow.operators.ranking import best_per_key
from packetflow.operators.relay import topic_messages, with_partition
from packetflow.session import spread
from packetflow.sources.batches import (
    BatchTable,
    CommitLog,
    CommitState,
    FoldedTable,
    checkpoint_id,
)

PUBLISHED = (
    "id STRING, " + schemas.TOPIC_RECORD + ", partition_id BIGINT, error STRING"
)

#: Fixed value: pause between two publications.
TICK = "500 milliseconds"


def published_table(path: str) -> BatchTable:
    return BatchTable(path, PUBLISHED)


def published_commits(path: str) -> CommitLog:
    """What streams have finished writing to :func:`published_table`; it lies beside the table."""
    return CommitLog.at(f"{path.rstrip('/')}-commits")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """Messages of finished batches."""
    return published_table(path).upto(spark, published_commits(path).last(spark))


def start_relay(
    outbox: DataFrame, path: str, checkpoint: str, available_now: bool = True, interval: str = TICK
) -> StreamingQuery:
    """Publish the rows of a streaming outbox to the message table at ``path``.

    The checkpoint takes the place of claims and of the processed flag: it knows which rows were
    sent, and a batch that failed is sent again as the same batch. Several checkpoints may write one
    after the other: batches are numbered on, and a row that another has sent is not sent again.
    Rows that keep an order of their own are left out, as they are by a claim.
    """
    spark = outbox.sparkSession
    table, commits = published_table(path), published_commits(path)
    table.create(spark)
    commits.create(spark)
    writer_id = checkpoint_id(spark, checkpoint)

    def publish(batch: DataFrame, stream_batch: int) -> None:
        session = batch.sparkSession
        state = commits.state(session)
        number = state.next_number(writer_id, stream_batch)
        if number is None:
            return
        unsent = (F.col("is_processed") == 0) & (F.col("is_sequential") == 0)
        pending = spread(batch, "id").filter(unsent)
        rows = None
        if state.others(writer_id):
            rows = pending.count()
            pending = without_stored(pending, table.upto(session, number - 1), "id", rows)
        table.write(with_partition(topic_messages(pending)), number)
        commits.write(session, state, writer_id, stream_batch, rows or 0)

    writer = outbox.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


@dataclass(frozen=True)
class StoredOutbox:
    """An outbox kept as versions of its rows: those added, claimed and done are written, no others.

    Rows may be added at any time. ``workers`` share the outbox by a hash of the id: each takes the
    rows of its share that were added since its last tick and keeps their versions in folders of its
    own, so workers never wait for each other and no row is claimed by two. Every so many ticks
    the versions of a worker fold into a snapshot without the rows that are done.

    The claim is written before anything is sent, so a send that fails leaves rows under a lease
    and they are claimed again when it has run out. A tick that is run again under its number
    overwrites what it left, one that is finished changes nothing.
    """

    root: str
    snapshot_every: int = 50
    workers: int = 1

    @property
    def added(self) -> BatchTable:
        """The rows as they were added, one folder for each call."""
        return BatchTable(f"{self.root}/added", schemas.OUTBOX)

    @property
    def additions(self) -> CommitLog:
        return CommitLog.at(f"{self.root}/additions")

    def ticks(self, worker: int = 0) -> CommitLog:
        """Finished ticks of a worker; ``rows`` is the last addition it has taken."""
        return CommitLog.at(f"{self.root}/worker-{worker}/ticks")

    def versions(self, worker: int = 0) -> FoldedTable:
        def fold(rows: DataFrame) -> DataFrame:
            return best_per_key(rows, ["id"], [F.col("version_no").desc()])

        schema = schemas.OUTBOX + ", version_no BIGINT"
        path = f"{self.root}/worker-{worker}/outbox"
        return FoldedTable.at(path, schema, fold, self.snapshot_every)

    def create(self, spark: SparkSession) -> None:
        for table in (self.added, self.additions):
            table.create(spark)
        for worker in range(self.workers):
            self.versions(worker).create(spark)
            self.ticks(worker).create(spark)

    def append(self, rows: DataFrame, writer: str = "", batch: int | None = None) -> None:
        """Add rows, such as a micro-batch of a stream: a batch that was added changes nothing."""
        spark = rows.sparkSession
        state = self.additions.state(spark)
        batch = state.written.get(writer, -1) + 1 if batch is None else batch
        number = state.next_number(writer, batch)
        if number is not None:
            self.added.write(rows, number)
            self.additions.write(spark, state, writer, batch, 0)

    def load(self, rows: DataFrame) -> None:
        """Start the outbox with these rows."""
        self.create(rows.sparkSession)
        self.append(rows)

    def _taken(self, spark: SparkSession, worker: int) -> tuple[CommitState, int]:
        """The finished ticks of a worker and the last addition it has taken, -1 for none."""
        log = self.ticks(worker)
        state = log.state(spark)
        taken = log.table.only(spark, state.last).first()["rows"] if state.last >= 0 else -1
        return state, taken

    def _new(self, spark: SparkSession, worker: int, taken: int) -> tuple[DataFrame, int]:
        """Rows of the worker's share that were added since, as versions, and the last addition."""
        last = self.additions.last(spark)
        rows = self.added.batches(spark, list(range(taken + 1, last + 1))).drop("batch_id")
        own = rows.filter(hash_slot(F.col("id"), self.workers) == worker)
        return own.withColumn("version_no", F.lit(-1).cast("bigint")), last

    def read(self, spark: SparkSession) -> DataFrame:
        """The outbox after all finished ticks, with the rows no worker has taken yet."""
        parts = []
        for worker in range(self.workers):
            state, taken = self._taken(spark, worker)
            parts.append(self.versions(worker).current(spark, 2 * state.last + 1))
            parts.append(self._new(spark, worker, taken)[0])
        return reduce(DataFrame.unionByName, parts).drop("version_no")

    def errors(self, spark: SparkSession, now_ms: int) -> DataFrame:
        """Rows that wait and can not be sent, as messages with an ``error``."""
        blank = self.read(spark).filter(is_blank(F.col("topic")))
        return topic_messages(ob.eligible(blank, now_ms))

    def tick(
        self,
        spark: SparkSession,
        number: int,
        now_ms: int,
        send: Callable[[DataFrame], None],
        limit: int = ob.CLAIM_LIMIT,
        lease_ms: int = ob.LEASE_MS,
        worker: int = 0,
    ) -> None:
        """Claim the oldest rows, send their messages, mark them done; ``number`` counts from 0."""
        ticks, taken = self._taken(spark, worker)
        if number <= ticks.last:
            return
        if number != ticks.last + 1:
            raise ValueError(f"tick {number} of worker {worker} comes after {ticks.last}")
        versions = self.versions(worker)
        claimed, done = 2 * number, 2 * number + 1
        new, upto = self._new(spark, worker, taken)

        def write(rows: DataFrame, version: int) -> None:
            numbered = rows.withColumn("version_no", F.lit(version).cast("bigint"))
            versions.write(numbered, version, keep=F.col("is_processed") == 0)

        state = versions.current(spark, claimed - 1).unionByName(new)
        sendable = state.filter(~is_blank(F.col("topic")))
        claims = ob.reserve(sendable, now_ms, limit, lease_ms)
        # new rows that are not claimed are taken over as they are, the fold keeps the claim
        taken_over = new.withColumn("version_no", F.lit(claimed).cast("bigint") - 1)
        marked = claims.withColumn("version_no", F.lit(claimed).cast("bigint"))
        folded = versions.fold(taken_over.unionByName(marked))
        versions.write(folded, claimed, keep=F.col("is_processed") == 0)
        held = versions.deltas.only(spark, claimed).drop("batch_id")
        claims = held.filter(F.col("version_no") == claimed)
        finished = claims.limit(0)
        try:
            send(topic_messages(claims))
            finished = claims.withColumn("is_processed", F.lit(1))
        finally:
            write(finished, done)
            self.ticks(worker).write(spark, ticks, "", number, upto)
