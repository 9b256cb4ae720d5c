"""Packet tables derived from ``events``: one definition, read by Spark and by the checking SQL.

A table is a chain of projections. Only four things differ between the engines, and they stand in
braces: epoch milliseconds, the one-or-two deliveries of an event, and how a chain is put together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.functions import api_key_hash
from packetflow.session import spread

#: Fixed value: the moment lease and marker tests are at, in the middle of the events.
NOW_MS = 1705300000000

#: Fixed value: arrival numbers of second deliveries start here.
SECOND_DELIVERY = 1_000_000_000

EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING"
)

SPARK = {
    "MS": "unix_millis(CAST(ts AS TIMESTAMP))",
    "DELIVERIES": "explode(CASE WHEN event_id % 7 = 0 THEN array(0, 1) ELSE array(0) END)",
}
DUCKDB = {
    "MS": "epoch_us(ts) // 1000",
    "DELIVERIES": "unnest(CASE WHEN event_id % 7 = 0 THEN [0, 1] ELSE [0] END)",
}


def _proto(missing: str) -> str:
    return (
        "CASE event_type WHEN 'click' THEN 'HTTPS' WHEN 'view' THEN ' tcp ' "
        "WHEN 'signup' THEN 'udp' WHEN 'purchase' THEN 'TLS' ELSE "
        f"CASE event_id % 3 WHEN 0 THEN 'ARP' WHEN 1 THEN 'ICMP' ELSE {missing} END END"
    )


def _keep(*names: str) -> dict[str, str]:
    return {name: name for name in names}


DEST_IP = "'10.1.0.' || CAST(event_id % 251 AS STRING)"
SOURCE_PORT = "1024 + event_id % 60000"

PACKET_REQUEST = [
    {
        "event_id": "event_id",
        "ts_ms": "{MS}",
        "source_port": f"CAST({SOURCE_PORT} AS INT)",
        "dest_port": "CAST(CASE event_type WHEN 'click' THEN 443 WHEN 'error' THEN 0 "
        "ELSE 1 + event_id % 1023 END AS INT)",
        "source_ip": "CASE WHEN event_id % 53 = 0 THEN '' ELSE '10.0.' || "
        "CAST(CAST(floor(user_id / 256) AS BIGINT) AS STRING) || '.' || "
        "CAST(user_id % 256 AS STRING) END",
        "dest_ip": DEST_IP,
        "source_mac": "'aa:bb:cc:dd:ee:ff'",
        "dest_mac": "'ff:ee:dd:cc:bb:aa'",
        "proto": _proto("''"),
    }
]

OUTBOX_TABLE = [
    {
        "id": "'ob-' || CAST(event_id AS STRING)",
        "date_timestamp_ms": "{MS}",
        "raw_data": """'{{"transaction_id":"tx-' || CAST(event_id AS STRING) || '"}}'""",
        "message_type": "'SnapshotMessage'",
        "topic": "'SnapshotTopic'",
        "partition_by": f"CASE WHEN event_id % 10 = 3 THEN NULL ELSE {DEST_IP} END",
        "is_processed": "CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END",
        "is_sequential": "CASE WHEN event_id % 9 = 0 THEN 1 ELSE 0 END",
        "metadata": "CASE WHEN event_id % 6 = 0 THEN NULL "
        """ELSE '{{"proto":"' || event_type || '"}}' END""",
        "reserved_at_ms": "CASE WHEN event_id % 5 = 0 THEN {MS} END",
        "expired_at_ms": "CASE WHEN event_id % 5 = 0 THEN {MS} + 20000 END",
        "is_processing": "CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END",
    }
]

TOPIC_MESSAGES = [
    {
        **_keep("event_id", "user_id"),
        "ms": "{MS}",
        "part": "event_id % 5",
        "proto": _proto("''"),
    },
    {
        **_keep("event_id", "ms", "part"),
        "payload": "CASE WHEN event_id % 59 = 0 THEN '   ' "
        "WHEN event_id % 47 = 0 THEN 'this is not json' ELSE "
        """'{{"transaction_id":"' || CASE WHEN event_id % 13 = 0 THEN ' ' """
        """ELSE 'tx-' || CAST(event_id AS STRING) END || '","client_id":"' || """
        """CASE WHEN event_id % 8 = 0 THEN '' ELSE 'c' || CAST(user_id AS STRING) END """
        """|| '","version":' || CAST(ms AS STRING) || ',"source_port":' || """
        f"""CAST({SOURCE_PORT} AS STRING) """
        """|| ',"dest_port":443,"source_ip":"10.0.0.' || CAST(user_id % 256 AS STRING) """
        f"""|| '","dest_ip":"' || {DEST_IP} """
        """|| '","source_mac":"aa:bb:cc:dd:ee:ff","dest_mac":"ff:ee:dd:cc:bb:aa","proto":"' """
        """|| proto || '"}}' END""",
    },
    {
        "topic": "'SnapshotTopic'",
        "msg_partition": "part",
        "msg_offset": "event_id",
        "msg_ts_ms": "ms",
        "msg_key": DEST_IP,
        "value": """CASE WHEN event_id % 61 = 0 THEN '{{ bad envelope' ELSE """
        f"""'{{{{"Topic":"SnapshotTopic","Key":"' || {DEST_IP} || '","Payload":"' || """
        """replace(payload, '"', chr(92) || '"') || '","PayloadType":"SnapshotMessage","""
        """"Metadata":{{"origin":"intake"}},"Created":"2024-01-01T00:00:00Z"}}' END""",
        "attempts_header": "CASE WHEN event_id % 43 = 0 THEN 'abc' WHEN event_id % 4 = 0 THEN NULL "
        "ELSE CAST(event_id % 4 - 1 AS STRING) END",
        "api_key": "CASE event_id % 3 WHEN 0 THEN 'valid_api_key_1' WHEN 1 THEN 'valid_api_key_2' "
        "ELSE 'not-a-real-key' END",
        "payload": "payload",
    },
]

CDC_FEED = [
    {
        **_keep("event_id", "user_id"),
        "ms": "{MS}",
        "first_proto": _proto("NULL"),
        "delivery": "{DELIVERIES}",
    },
    {
        **_keep("event_id", "user_id", "ms", "delivery"),
        "proto": "CASE WHEN delivery = 1 THEN 'DNS' ELSE first_proto END",
    },
    {
        "event_id": "event_id",
        "arrival_seq": f"event_id + delivery * CAST({SECOND_DELIVERY} AS BIGINT)",
        "arrival_ms": "ms + 1000 * (1 + delivery)",
        "good": """'{{"__op":"' || CASE WHEN event_id % 11 = 0 THEN 'd' """
        """WHEN event_id % 12 = 0 THEN 'u' ELSE 'c' END || '","transaction_id":' || """
        """CASE WHEN event_id % 13 = 0 THEN '"  "' WHEN event_id % 41 = 0 THEN 'null' """
        """ELSE '"tx-' || CAST(event_id AS STRING) || '"' END """
        """|| ',"client_id":"c' || CAST(user_id AS STRING) || '","version":' || """
        """CAST((ms - CASE WHEN event_id % 5 = 0 THEN 86400000 ELSE 0 END) """
        """- (ms % 21600000) + delivery AS STRING) """
        """|| CASE WHEN proto IS NULL THEN '' ELSE ',"proto":"' || proto || '"' END """
        """|| ',"source_ip":"10.0.0.' || CAST(user_id % 256 AS STRING) || '","source_port":' || """
        f"""CAST({SOURCE_PORT} AS STRING) """
        """|| ',"storedAt":' || CASE WHEN event_id % 23 = 0 THEN 'null' """
        """WHEN event_id % 29 = 0 THEN '"not a date"' ELSE CAST(ms AS STRING) END || '}}'""",
    },
    {
        **_keep("arrival_seq", "arrival_ms"),
        "msg_partition": "event_id % 5",
        "value": "CASE WHEN event_id % 17 = 0 THEN '{{ unterminated' "
        "WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 31 = 0 THEN '[1, 2, 3]' "
        "WHEN event_id % 37 = 0 THEN good || ' trailing' ELSE good END",
    },
]

#: Filtered on ``seen`` by whoever uses it.
SEEN_MARKERS = [
    {
        "transaction_id": "'tx-' || CAST(event_id AS STRING)",
        "marked_at_ms": "{MS}",
        "seen": "event_id % 3 = 0",
    }
]

CALLS = [
    {
        "call_id": "event_id",
        "ts_ms": "{MS}",
        "subject": "CASE WHEN event_id % 3 = 0 THEN 'sub-' || CAST(user_id % 5 AS STRING) END",
        "user_name": "CASE WHEN event_id % 3 = 1 THEN 'name-' || CAST(user_id % 5 AS STRING) END",
        "remote_ip": "CASE WHEN event_id % 7 = 0 THEN NULL "
        "ELSE '10.0.0.' || CAST(user_id % 5 AS STRING) END",
    }
]

TABLES = {
    "packet_request": PACKET_REQUEST,
    "outbox_table": OUTBOX_TABLE,
    "topic_messages": TOPIC_MESSAGES,
    "cdc_feed": CDC_FEED,
    "all_markers": SEEN_MARKERS,
    "calls": CALLS,
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/events.parquet"), "event_id")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream, be the table one file or a folder of them; none is an error."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{sf_dir}/events.parquet")
    status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if status.isDirectory():
        return reader.parquet(path.toString())
    # A stream reads folders only: the folder is named, and the file in it.
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def table(source: DataFrame, name: str) -> DataFrame:
    """A derived table over events, batch or stream."""
    df = source
    for step in TABLES[name]:
        df = df.selectExpr(*[f"{expr.format(**SPARK)} AS {col}" for col, expr in step.items()])
    return df


#: Micro-batches of the feed, and how long after the fixture's moment each comes.
STAGES = 3
STAGE_AFTER_MS = (0, 86_400_000, 648_000_000)

STAGE = (
    f"CASE WHEN arrival_seq < {SECOND_DELIVERY} THEN arrival_seq % 2 "
    f"WHEN (arrival_seq - {SECOND_DELIVERY}) % 3 = 0 THEN 1 ELSE 2 END"
)
STAGE_CLOCK = (
    f"CAST({NOW_MS} AS BIGINT) + CASE {STAGE} WHEN 0 THEN {STAGE_AFTER_MS[0]} "
    f"WHEN 1 THEN {STAGE_AFTER_MS[1]} ELSE {STAGE_AFTER_MS[2]} END"
)


def staged(feed: DataFrame) -> DataFrame:
    """The feed with the micro-batch each event comes in and that batch's clock."""
    return feed.selectExpr("*", f"{STAGE} AS stage", f"{STAGE_CLOCK} AS processed_ms")


#: Where the calls of the second and the third micro-batch begin, within windows.
CALL_CUTS_MS = (NOW_MS - 10_000_000, NOW_MS + 15_000_000)

#: Fixed value: messages of one part of a topic that is read in bounded batches.
PART_MESSAGES = 1500

#: Fixed value: rows of the outbox that are added after the first ticks.
ADDED_LATER = "CAST(substr(id, 4) AS BIGINT) % 3 = 2"

BLANK_TOPIC = "CASE WHEN CAST(substr(id, 4) AS BIGINT) % 10 = 7 THEN ' ' ELSE topic END"


def some_blank_topics(outbox: DataFrame) -> DataFrame:
    return outbox.withColumn("topic", F.expr(BLANK_TOPIC))


def seen_markers(source: DataFrame) -> DataFrame:
    return table(source, "all_markers").filter("seen").drop("seen")


def with_headers(messages: DataFrame) -> DataFrame:
    """Topic rows as a topic has them: the attempt counter is a header."""
    counter = F.struct(
        F.lit("attempts").alias("key"), F.col("attempts_header").cast("binary").alias("value")
    )
    headers = F.when(F.col("attempts_header").isNotNull(), F.array(counter))
    hashed = messages.withColumn("api_key_hash", api_key_hash(F.col("api_key")))
    return hashed.withColumn("headers", headers).drop("attempts_header", "payload", "api_key")


def ctes(*names: str) -> list[str]:
    """Derived tables as common table expressions of the checking SQL."""
    parts = []
    for name in names:
        source = "events"
        for number, step in enumerate(TABLES[name]):
            last = number == len(TABLES[name]) - 1
            target = name if last else f"{name}_{number}"
            columns = ", ".join(f"{e.format(**DUCKDB)} AS {c}" for c, e in step.items())
            parts.append(f"{target} AS (SELECT {columns} FROM {source})")
            source = target
    return parts
