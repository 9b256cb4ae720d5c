"""From claimed outbox rows to topic messages."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetflow.functions import hash_slot, is_blank, message_headers
from packetflow.operators import outbox as ob

#: Fixed value: partitions of a topic.
TOPIC_PARTITIONS = 5

#: Key of messages that have none; one constant, so they share a partition.
DEFAULT_KEY = "no-key"


def metadata_map(text: Column) -> Column:
    """Metadata as a map; empty or missing text is null."""
    return F.when(F.length(text) > 0, F.from_json(text, "map<string,string>"))


def iso_millis(ms: Column) -> Column:
    """Epoch milliseconds as ISO time in UTC."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def topic_messages(rows: DataFrame, default_key: str = DEFAULT_KEY) -> DataFrame:
    """Messages of outbox rows, in the columns a Kafka sink writes, plus id and error.

    ``value`` is the JSON envelope. A row whose topic is blank cannot be sent: ``error`` says so.
    """
    with_map = rows.withColumn("__metadata", metadata_map(F.col("metadata")))
    envelope = F.struct(
        F.col("topic").alias("Topic"),
        F.col("partition_by").alias("Key"),
        F.col("raw_data").alias("Payload"),
        F.col("message_type").alias("PayloadType"),
        F.col("__metadata").alias("Metadata"),
        iso_millis(F.col("date_timestamp_ms")).alias("Created"),
    )
    return with_map.select(
        "id",
        "topic",
        F.coalesce(F.col("partition_by"), F.lit(default_key)).alias("key"),
        F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value"),
        message_headers(
            F.col("date_timestamp_ms"), F.col("message_type"), F.col("__metadata")
        ).alias("headers"),
        F.when(is_blank(F.col("topic")), F.lit("blank topic")).alias("error"),
    )


def with_partition(
    messages: DataFrame, key: str = "key", partitions: int = TOPIC_PARTITIONS
) -> DataFrame:
    """Add ``partition_id``: equal keys, equal partition. Adds a column, moves no rows."""
    return messages.withColumn("partition_id", hash_slot(F.col(key), partitions))


class Tick(NamedTuple):
    """What one run of the relay sends, the outbox once it is sent, and what can not be sent."""

    messages: DataFrame
    outbox: DataFrame
    errors: DataFrame


def relay_tick(
    outbox: DataFrame, now_ms: int, limit: int = ob.CLAIM_LIMIT, lease_ms: int = ob.LEASE_MS
) -> Tick:
    """Claim, turn into messages, mark as processed.

    Nothing is written here, and messages and outbox each work out the claim; a job that sends
    writes the claim first (:class:`packetflow.streaming.relay.StoredOutbox`). Rows with a blank
    topic are never claimed, so they stand in nobody's way.
    """
    blank = is_blank(F.col("topic"))
    claims = ob.reserve(outbox.filter(~blank), now_ms, limit, lease_ms)
    messages = topic_messages(claims)
    errors = topic_messages(ob.eligible(outbox.filter(blank), now_ms))
    done = claims.withColumn("is_processed", F.lit(1))
    fields = ["is_processed", "is_processing", "reserved_at_ms", "expired_at_ms"]
    update = done.select("id", F.struct(*fields).alias("__after"))
    if limit <= ob.MAX_BROADCAST_KEYS:
        update = F.broadcast(update)
    joined = outbox.join(update, "id", "left")
    after = {f: F.coalesce(F.col("__after")[f], F.col(f)) for f in fields}
    return Tick(messages, joined.withColumns(after).select(*outbox.columns), errors)
