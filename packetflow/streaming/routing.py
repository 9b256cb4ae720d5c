"""Routing of a topic by a stream: shards, retries, dead letters and refused senders."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from packetflow import schemas
from packetflow.operators import auth, routing
from packetflow.operators.joins import without_stored
from packetflow.session import spread, together
from packetflow.sources.batches import BatchTable, CommitLog, checkpoint_id
from packetflow.sources.shards import shard_table
from packetflow.sources.topics import HASH_HEADER


#: Messages of a micro-batch that are worth a task of their own when they are written.
ROWS_PER_TASK = 200_000


class TargetUnreachable(RuntimeError):
    """Raised when the store cannot be reached: the batch is replayed, no attempt is counted."""


DEAD_LETTER = schemas.TOPIC_RECORD + """,
    attempts INT, origin_topic STRING, origin_msg_partition BIGINT, origin_msg_offset BIGINT
"""


@dataclass(frozen=True)
class Router:
    """Sinks below ``root``; retries go to ``retry_path``, where the source finds them again.

    Senders are known by the hashes of their keys: of ``valid_keys``, or a table of hashes. With
    neither, nobody is, unless ``allow_anyone`` says that there is no authentication.

    With ``publish``, such as :func:`packetflow.sources.topics.write_kafka` to some servers, retries
    and dead letters are sent to their topics instead of written to folders; a retry carries the
    hash of its sender in a header.
    """

    root: str
    retry_path: str | None = None
    valid_keys: Sequence[str] | None = None
    valid_hashes: DataFrame | None = None
    allow_anyone: bool = False
    down_shards: Sequence[str] = ()
    max_attempts: int = routing.MAX_ATTEMPTS
    main_topic: str = routing.MAIN_TOPIC
    reachable: Callable[[], bool] = lambda: True
    publish: Callable[[DataFrame], None] | None = None

    @property
    def shards(self) -> BatchTable:
        return shard_table(f"{self.root}/shards")

    @property
    def dead_letters(self) -> BatchTable:
        return BatchTable(f"{self.root}/dead_letters", DEAD_LETTER)

    @property
    def refused(self) -> BatchTable:
        return BatchTable(f"{self.root}/refused", schemas.TOPIC_MESSAGE)

    @property
    def retries(self) -> BatchTable:
        """Messages sent again, in the shape the source reads."""
        path = self.retry_path or f"{self.root}/retries"
        return BatchTable(path, schemas.TOPIC_MESSAGE + ", attempts INT")

    @property
    def commits(self) -> CommitLog:
        return CommitLog.at(f"{self.root}/commits")

    def create(self, spark: SparkSession) -> None:
        for table in (self.shards, self.dead_letters, self.refused, self.commits, self.retries):
            table.create(spark)

    def route(self, batch: DataFrame, stream_batch: int, writer: str = "") -> None:
        """Route one micro-batch: authenticate, decide once, write each sink.

        ``writer`` names the stream, whose batches are counted by ``stream_batch``; one that is
        finished already changes nothing. Where another stream has written too, what it stored is
        looked up, so that a topic that is read again is stored once.
        """
        if not self.reachable():
            raise TargetUnreachable(f"batch {stream_batch} was not delivered")
        spark = batch.sparkSession
        state = self.commits.state(spark)
        batch_id = state.next_number(writer, stream_batch)
        if batch_id is None:
            return
        again = state.others(writer)
        messages = spread(batch, *routing.COORDINATES)
        checked = messages.persist(StorageLevel.MEMORY_AND_DISK)
        routed = checked

        def write(table: BatchTable, rows: DataFrame, tasks: int, *key: str) -> None:
            if again:
                rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
                stored = table.upto(spark, batch_id - 1)
                fresh = without_stored(rows, stored, key, rows.count())
                table.write(fresh.coalesce(tasks), batch_id)
                rows.unpersist()
            else:
                table.write(rows.coalesce(tasks), batch_id)

        try:
            accepted, refused = self._admitted(checked)
            routed = routing.route(accepted, self.down_shards)
            routed = routed.persist(StorageLevel.MEMORY_AND_DISK)
            rows = routed.count()
            # a task writes a file for each shard it has: no more tasks than rows are worth
            tasks = max(1, -(-rows // ROWS_PER_TASK))
            documents = routing.shard_documents(routed, F.col("msg_ts_ms"), self.down_shards)
            dead = routing.dead_letters(routed, max_attempts=self.max_attempts)
            jobs = [lambda: write(self.shards, documents, tasks, "packet_id")]
            if refused is not None:
                jobs.append(lambda: write(self.refused, refused, tasks, *routing.COORDINATES))
            if self.publish:
                retried = routing.retry_messages(routed, self.main_topic, self.max_attempts)
                jobs.append(lambda: self.publish(self._sendable(retried.unionByName(dead))))
            else:
                of_origin = [c for c in StructType.fromDDL(DEAD_LETTER).names if "origin" in c]
                tried = (*routing.COORDINATES, "attempts")
                jobs.append(lambda: write(self.dead_letters, dead, tasks, *of_origin, "attempts"))
                jobs.append(lambda: write(self.retries, self._resent(routed), tasks, *tried))
            together(spark, *jobs)
            self.commits.write(spark, state, writer, stream_batch, rows)
        finally:
            routed.unpersist()
            checked.unpersist()

    def stored(self, spark: SparkSession, table: BatchTable) -> DataFrame:
        """What finished batches have written to one of the tables."""
        return table.upto(spark, self.commits.last(spark))

    def _admitted(self, messages: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """The messages of known senders, and the others."""
        if self.allow_anyone:
            return messages, None
        if self.valid_hashes is not None:
            valid, size = self.valid_hashes.select(auth.HASH), None
        else:
            valid = auth.valid_hashes(messages, self.valid_keys or [""])
            size = len(self.valid_keys or [""])
        known = (valid, routing.COORDINATES, size)
        return auth.accepted(messages, *known), auth.rejected(messages, *known)

    def _sendable(self, messages: DataFrame) -> DataFrame:
        sender = F.struct(
            F.lit(HASH_HEADER).alias("key"),
            F.col("origin_api_key_hash").cast("binary").alias("value"),
        )
        known = F.when(F.col("origin_api_key_hash").isNull(), F.col("headers")).otherwise(
            F.concat("headers", F.array(sender))
        )
        return messages.select("topic", "key", "value", known.alias("headers"))

    def _resent(self, routed: DataFrame) -> DataFrame:
        """Retries as topic rows, under the coordinates of the message they repeat.

        A broker would number them anew. Here they keep their numbers, so an id made from them is
        the same for all tries and a line stored by an earlier try is known as the same packet.
        """
        again = routing.retry_messages(routed, self.main_topic, self.max_attempts)
        return again.select(
            "topic",
            F.col("origin_msg_partition").alias("msg_partition"),
            F.col("origin_msg_offset").alias("msg_offset"),
            F.col("origin_msg_ts_ms").alias("msg_ts_ms"),
            F.col("key").alias("msg_key"),
            "value",
            "headers",
            F.col("origin_api_key_hash").alias("api_key_hash"),
            "attempts",
        )

    def start(
        self,
        topic: DataFrame,
        checkpoint: str,
        available_now: bool = True,
        interval: str = "5 seconds",
    ) -> StreamingQuery:
        """Route a stream of topic rows.

        Several checkpoints may write one after the other, in any order, and may read messages that
        another has routed: batches are numbered on, and what is stored is not stored again.
        Messages that are published, rather than stored, are sent again.
        """
        spark = topic.sparkSession
        self.create(spark)
        writer_id = checkpoint_id(spark, checkpoint)

        def route(batch: DataFrame, batch_id: int) -> None:
            self.route(batch, batch_id, writer_id)

        writer = topic.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
        trigger = {"availableNow": True} if available_now else {"processingTime": interval}
        return writer.trigger(**trigger).start()
