"""Topics: Kafka where its connector is on the class path, or files of the same row shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from packetflow import schemas
from packetflow.functions import api_key_hash
from packetflow.operators.routing import CHANGE_TOPICS


def _kafka_rows(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    stream = (
        spark.readStream.format("kafka")
        .option("startingOffsets", "earliest")
        .option("includeHeaders", "true")
    )
    raw = stream.options(**options).load()
    return raw.select(
        "topic",
        F.col("partition").cast("bigint").alias("msg_partition"),
        F.col("offset").alias("msg_offset"),
        F.unix_millis("timestamp").alias("msg_ts_ms"),
        F.col("key").cast("string").alias("msg_key"),
        F.col("value").cast("string").alias("value"),
        "headers",
        _sender(F.col("headers")).alias("api_key_hash"),
    )


#: Name of the header that holds the key of the sender, or the hash of the key.
KEY_HEADER, HASH_HEADER = "api_key", "api_key_hash"


def _sender(headers: Column) -> Column:
    """The hash of the sender's key out of the headers; the key itself goes no further."""

    def last(name: str) -> Column:
        found = F.try_element_at(F.filter(headers, lambda h: h["key"] == name), F.lit(-1))
        return found["value"].cast("string")

    return F.coalesce(last(HASH_HEADER), api_key_hash(last(KEY_HEADER)))


def without_sender(headers: Column) -> Column:
    """The headers without the key of the sender, for storage."""
    return F.filter(headers, lambda h: h["key"] != KEY_HEADER)


def kafka_topic(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None, **options: str
) -> DataFrame:
    """A stream of one topic from its start; ``max_offsets`` bounds a micro-batch.

    Pass ``minPartitions`` to read a topic of few partitions with many tasks.
    """
    limit = {"maxOffsetsPerTrigger": str(max_offsets)} if max_offsets else {}
    base = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    return _kafka_rows(spark, {**base, **limit, **options})


def kafka_pattern(
    spark: SparkSession, servers: str, pattern: str = CHANGE_TOPICS, **options: str
) -> DataFrame:
    """A stream of all topics that match, new ones included as they appear."""
    fresh = {"kafka.metadata.max.age.ms": "10000"}
    base = {"kafka.bootstrap.servers": servers, "subscribePattern": pattern}
    return _kafka_rows(spark, {**base, **fresh, **options})


def arrival(topic: DataFrame) -> DataFrame:
    """Change events of topic rows, in an order that every replay gives the same way.

    No order holds across partitions. ``arrival_seq`` is the offset; ``topic`` and
    ``msg_partition`` tell equal ones apart, however many there are of either.
    """
    return topic.select(
        F.col("msg_offset").alias("arrival_seq"),
        F.col("msg_ts_ms").alias("arrival_ms"),
        "topic",
        "msg_partition",
        "value",
    )


def file_topic(
    spark: SparkSession,
    path: str,
    schema: str | StructType = schemas.TOPIC_MESSAGE,
    max_files: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """A stream of Parquet files below ``path``, sub-folders included."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def file_topics(
    spark: SparkSession,
    path: str,
    pattern: str = CHANGE_TOPICS,
    schema: str | StructType = "value STRING",
    max_files: int | None = None,
) -> DataFrame:
    """A stream of all topics below ``path`` whose name matches, each a folder ``topic=<name>``.

    Folders are looked for anew before each micro-batch, so a topic that appears later is read from
    its start. Rows get the ``topic`` of their folder; those of other topics go no further.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    named = F.regexp_extract(F.col("_metadata.file_path"), "/topic=([^/]+)/[^/]*$", 1)
    rows = reader.parquet(f"{path}/topic=*")
    return rows.withColumn("topic", F.url_decode(named)).filter(F.col("topic").rlike(pattern))


def write_kafka(messages: DataFrame, servers: str, **options: str) -> None:
    """Send messages (``topic``, ``key``, ``value``, ``headers``); returns once all are sent.

    Messages with an ``error`` can not be sent and are left to whoever reads the errors.
    """
    if "error" in messages.columns:
        messages = messages.filter(F.col("error").isNull())
    sendable = messages.select("topic", "key", "value", "headers")
    writer = sendable.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("includeHeaders", "true").options(**options).save()
