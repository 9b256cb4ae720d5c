"""Row shapes, as DDL."""

PACKET_REQUEST = """
    source_port INT, dest_port INT, source_ip STRING, dest_ip STRING,
    source_mac STRING, dest_mac STRING, proto STRING
"""

SNAPSHOT = """
    transaction_id STRING, client_id STRING, version BIGINT, source_port INT, dest_port INT,
    source_ip STRING, dest_ip STRING, source_mac STRING, dest_mac STRING, proto STRING
"""

OUTBOX = """
    id STRING, date_timestamp_ms BIGINT, raw_data STRING, message_type STRING, topic STRING,
    partition_by STRING, is_processed INT, is_sequential INT, metadata STRING,
    reserved_at_ms BIGINT, expired_at_ms BIGINT, is_processing INT
"""

#: A topic as files, row for row what a Kafka source gives.
TOPIC_MESSAGE = """
    topic STRING, msg_partition BIGINT, msg_offset BIGINT, msg_ts_ms BIGINT, msg_key STRING,
    value STRING, headers ARRAY<STRUCT<key: STRING, value: BINARY>>, api_key_hash STRING
"""

#: A message to send, in the columns a Kafka sink takes.
TOPIC_RECORD = """
    topic STRING, key STRING, value STRING,
    headers ARRAY<STRUCT<key: STRING, value: BINARY>>
"""

SHARD_DOCUMENT = SNAPSHOT + """,
    packet_id STRING, msg_partition BIGINT, msg_offset BIGINT, line_no INT, stored_at_ms BIGINT,
    shard STRING
"""

CHANGE_EVENT = (
    "arrival_seq BIGINT, arrival_ms BIGINT, topic STRING, msg_partition BIGINT, value STRING"
)

LEDGER = """
    transaction_id STRING, client_id STRING, version BIGINT, proto STRING, source_ip STRING,
    dest_ip STRING, source_port INT, dest_port INT, stored_at TIMESTAMP, payload VARIANT,
    arrival_seq BIGINT, arrival_ms BIGINT
"""

CLIENT_STATE = """
    client_id STRING, version BIGINT, last_proto STRING, updated_at_ms BIGINT, arrival_seq BIGINT,
    batch_no BIGINT
"""

PROTOCOL_STATS = "proto STRING, packet_count BIGINT, first_seen TIMESTAMP, last_seen TIMESTAMP"

MARKERS = "transaction_id STRING, marked_at_ms BIGINT"

QUARANTINE = CHANGE_EVENT + ", skip_reason STRING"
