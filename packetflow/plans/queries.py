"""One query per operator, over tables derived from ``events`` (and ``documents`` for lines).

Times leave as epoch milliseconds and bytes as hex, so results compare without regard to types
that engines print differently.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import replace
from typing import ClassVar

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from packetflow import schemas
from packetflow.functions import (
    attempt_count,
    classify_protocol,
    message_headers,
    split_lines,
)
from packetflow.operators import (
    admission,
    auth,
    changes,
    ingest,
    outbox,
    projection,
    relay,
    routing,
    stats,
)
from packetflow.plans import fixtures as fx
from packetflow.session import bare_settings, plain_files, prepare, short_batches, work_dir
from packetflow.sources.batches import BatchTable
from packetflow.sources.shards import (
    MergedShards,
    read_shards,
    shard_change_stream,
    shard_table,
)
from packetflow.sources.topics import file_topic, file_topics
from packetflow.streaming.read_model import ReadModel
from packetflow.streaming.relay import (
    StoredOutbox,
    published_table,
    read_published,
    start_relay,
)
from packetflow.streaming.routing import Router, TargetUnreachable
from packetflow.streaming.stateful import Admission, LiveStats, SeenLedger

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries, also found in the checking SQL.
DOWN = ("ARP",)
VALID_KEYS = ("valid_api_key_1", "valid_api_key_2")
WORKERS = 4
WORKER_LIMIT = 40
PERMITS = 3
WINDOW_MS = 21_600_000
LOOKUP_TX = "tx-1"
LOOKUP_CLIENT = "c1"

#: Streams that share the parts of a topic which is read in bounded batches, and messages that a
#: task deals out to them.
BOUNDED_READERS = 16
DEALT_MESSAGES = 100_000

RECORD = [
    "arrival_seq", "transaction_id", "client_id", "version", "proto", "source_ip", "dest_ip",
    "source_port", "dest_port",
]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        return fn

    return register


def millis(column: str) -> Column:
    return F.unix_millis(column).alias(f"{column}_ms")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fx.table(fx.events(spark, sf_dir), name)


def topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.with_headers(source(spark, sf_dir, "topic_messages"))


def parsed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.parse_changes(source(spark, sf_dir, "cdc_feed"))


def feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.records(parsed_feed(spark, sf_dir))


def full_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.first_arrivals(feed_records(spark, sf_dir))


def earlier_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as it was at the fixture's moment."""
    known = feed_records(spark, sf_dir).filter(F.col("arrival_ms") <= fx.NOW_MS)
    return projection.first_arrivals(known)


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.seen_markers(fx.events(spark, sf_dir))


def state_columns(state: DataFrame) -> DataFrame:
    return state.select("client_id", "version", "last_proto", "updated_at_ms")


def stats_columns(df: DataFrame) -> DataFrame:
    return df.select("proto", "packet_count", millis("first_seen"), millis("last_seen"))


# --- intake and outbox ---------------------------------------------------------------------------


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = source(spark, sf_dir, "packet_request")
    return ingest.ingest_packets(requests, F.col("ts_ms"), [F.lit("ingest"), F.col("event_id")])


@query("ingest_snapshot")
def ingest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots(spark, sf_dir).select(*outbox.SNAPSHOT_FIELDS)


@query("ingest_accepted")
def ingest_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.accepted_counts(source(spark, sf_dir, "packet_request"), "source_ip")


@query("batch_numbers")
def batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = source(spark, sf_dir, "packet_request").select("source_ip", "event_id")
    return ingest.intake_batches(requests, "source_ip", "event_id", size=10)


def appended(df: DataFrame) -> DataFrame:
    return outbox.outbox_rows(
        df,
        routing.MAIN_TOPIC,
        F.col("version"),
        partition_by=F.col("dest_ip"),
        metadata=F.create_map(F.lit("proto"), F.col("proto")),
    )


@query("outbox_append")
def outbox_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return appended(snapshots(spark, sf_dir))


@query("outbox_eligible")
def outbox_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outbox.eligible(source(spark, sf_dir, "outbox_table"), fx.NOW_MS)
    return rows.select("id", "date_timestamp_ms", "is_processing", "expired_at_ms")


CLAIM = ["id", "date_timestamp_ms", "is_processing", "reserved_at_ms", "expired_at_ms"]


@query("outbox_reserve")
def outbox_reserve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbox.reserve(source(spark, sf_dir, "outbox_table"), fx.NOW_MS).select(*CLAIM)


def claims_of_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "outbox_table")
    return outbox.worker_claims(rows, fx.NOW_MS, WORKERS, WORKER_LIMIT)


@query("outbox_worker_claims")
def outbox_worker_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims_of_workers(spark, sf_dir).select(*CLAIM, "worker", "claim_rank")


@query("claim_audit")
def claim_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbox.claim_audit(claims_of_workers(spark, sf_dir))


@query("outbox_mark_processed")
def outbox_mark_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "outbox_table")
    claims = outbox.reserve(rows, fx.NOW_MS)
    after = outbox.mark_processed(rows, claims, max_ids=outbox.CLAIM_LIMIT)
    return after.select("id", "is_processed")


@query("outbox_cleanup")
def outbox_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbox.cleanup(source(spark, sf_dir, "outbox_table")).select("id", "topic")


@query("relay_publish")
def relay_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = outbox.reserve(source(spark, sf_dir, "outbox_table"), fx.NOW_MS)
    return relay.topic_messages(claims).select("id", "topic", "key", "value", "error")


@query("relay_tick")
def relay_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    tick = relay.relay_tick(source(spark, sf_dir, "outbox_table"), fx.NOW_MS)
    return tick.outbox.select(
        "id", "is_processed", "is_processing", "reserved_at_ms", "expired_at_ms"
    )


@query("message_headers")
def message_headers_of_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "outbox_table")
    metadata = relay.metadata_map(F.col("metadata"))
    headers = message_headers(F.col("date_timestamp_ms"), F.col("message_type"), metadata)
    items = rows.select("id", F.posexplode(headers).alias("header_no", "header"))
    return items.select(
        "id",
        "header_no",
        F.col("header")["key"].alias("header_key"),
        F.lower(F.hex(F.col("header")["value"])).alias("header_value_hex"),
    )


@query("partition_assignment")
def partition_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = relay.topic_messages(source(spark, sf_dir, "outbox_table"))
    return relay.with_partition(messages).select("id", "key", "partition_id")


# --- routing -------------------------------------------------------------------------------------


def envelope_columns(decoded: DataFrame) -> DataFrame:
    env = F.col("envelope")
    return decoded.select(
        "msg_offset",
        env.isNotNull().cast("int").alias("well_formed"),
        env["Topic"].alias("envelope_topic"),
        env["Key"].alias("envelope_key"),
        env["Payload"].alias("payload"),
        env["PayloadType"].alias("payload_type"),
        F.try_element_at(env["Metadata"], F.lit("origin")).alias("origin"),
        F.unix_millis(env["Created"].try_cast("timestamp")).alias("created_ms"),
    )


@query("decode_envelope")
def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope_columns(routing.decode_envelope(topic_rows(spark, sf_dir)))


@query("attempt_count")
def attempt_count_of_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    counter = attempt_count(F.col("headers"))
    return topic_rows(spark, sf_dir).select("msg_offset", counter.alias("attempts"))


def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topic_rows(spark, sf_dir)
    return rows.select("msg_offset", auth.HASH)


@query("api_key_hash")
def api_key_hash_of_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed(spark, sf_dir)


@query("auth_accepted")
def auth_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hashed(spark, sf_dir)
    return auth.accepted(rows, auth.valid_hashes(rows, VALID_KEYS), ["msg_offset"], len(VALID_KEYS))


@query("auth_rejected")
def auth_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hashed(spark, sf_dir)
    return auth.rejected(rows, auth.valid_hashes(rows, VALID_KEYS), ["msg_offset"], len(VALID_KEYS))


@query("split_lines")
def split_lines_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.select("doc_id", F.posexplode(split_lines(F.col("text"))).alias("no", "line"))


@query("classify_protocol")
def classify_protocol_of_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = source(spark, sf_dir, "packet_request")
    return requests.select(
        "event_id", "proto", classify_protocol(F.col("proto")).alias("protocol")
    )


@query("classify_payload")
def classify_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = source(spark, sf_dir, "topic_messages").select("msg_offset", "payload")
    return routing.classify_payload(payloads, "payload").select("msg_offset", "protocol")


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.route(topic_rows(spark, sf_dir), DOWN)


@query("delivery_verdicts")
def delivery_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed(spark, sf_dir).select("msg_offset", "verdict", "reason", "attempts")


def resent_columns(resent: DataFrame) -> DataFrame:
    reason = F.filter("headers", lambda h: h["key"] == "x-failure-reason")
    return resent.select(
        F.col("origin_msg_offset").alias("msg_offset"),
        "topic",
        "key",
        "value",
        "attempts",
        attempt_count(F.col("headers")).alias("attempts_header"),
        F.try_element_at(reason, F.lit(1))["value"].cast("string").alias("failure_reason"),
    )


@query("retry_messages")
def retry_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resent_columns(routing.retry_messages(routed(spark, sf_dir)))


@query("dead_letters")
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resent_columns(routing.dead_letters(routed(spark, sf_dir)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.shard_documents(routed(spark, sf_dir), F.col("msg_ts_ms"), DOWN)


@query("shard_documents")
def shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).drop("topic", "msg_partition", "line_no")


@query("shard_counts")
def shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.shard_counts(documents(spark, sf_dir))


@query("shard_change_feed")
def shard_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.change_feed(documents(spark, sf_dir)).select("topic", "shard", "value")


@query("cdc_union_shards")
def cdc_union_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of all stored shards in one scan, picked by name out of other topics."""
    path = work_dir(spark, "shards")
    shard_table(path).write(documents(spark, sf_dir), 0)
    feed = routing.change_feed(read_shards(spark, path)).select("topic", "value")
    messages = topic_rows(spark, sf_dir).select("topic", "msg_offset", "value")
    named = F.when(F.col("msg_offset") % 2 == 0, "pcap.tcp.pcap.packets.old").otherwise(
        F.when(F.col("msg_offset") % 3 == 0, "copy.pcap.tcp.packets").otherwise(F.col("topic"))
    )
    others = messages.select(named.alias("topic"), "value")
    return routing.matching_topics(changes.union_feeds(feed, others))


# --- read side -----------------------------------------------------------------------------------


@query("parse_change_events")
def parse_change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_records(spark, sf_dir).select(*RECORD, millis("stored_at"))


@query("parse_stored_at")
def parse_stored_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = feed_records(spark, sf_dir)
    return recs.select(
        "arrival_seq", millis("stored_at"), F.col("stored_at").isNull().cast("int").alias("missing")
    )


@query("skipped_events")
def skipped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.skipped_counts(parsed_feed(spark, sf_dir))


@query("payload_roundtrip")
def payload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.with_payload(full_ledger(spark, sf_dir))
    pairs = F.map_entries(F.try_variant_get("payload", "$", "map<string,string>"))
    joined = F.array_sort(
        F.transform(
            pairs, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")))
        )
    )
    keys = F.array_sort(F.json_object_keys(F.to_json("payload")))
    return rows.select(
        "transaction_id",
        F.array_join(keys, ",").alias("payload_keys"),
        F.array_join(joined, ",").alias("payload_fields"),
    )


@query("payload_field")
def payload_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.with_payload(full_ledger(spark, sf_dir))
    payload = F.col("payload")
    return rows.select(
        "transaction_id",
        changes.payload_field(payload, "proto").alias("payload_proto"),
        changes.payload_field(payload, "transaction_id").alias("payload_transaction_id"),
        changes.payload_field(payload, "storedAt").alias("payload_stored_at"),
    )


@query("projection_outcomes")
def projection_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.outcome_counts(
        parsed_feed(spark, sf_dir), seen(spark, sf_dir), earlier_ledger(spark, sf_dir), fx.NOW_MS
    )


def past_fast_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.fast_path(full_ledger(spark, sf_dir), seen(spark, sf_dir), fx.NOW_MS)


@query("fast_path_filter")
def fast_path_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return past_fast_path(spark, sf_dir).select("arrival_seq", "transaction_id", "proto")


@query("marker_update")
def marker_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = past_fast_path(spark, sf_dir)
    return projection.update_markers(seen(spark, sf_dir), stored, fx.NOW_MS)


@query("ledger")
def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_ledger(spark, sf_dir).select(*RECORD, millis("stored_at"))


@query("ledger_new_rows")
def ledger_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = projection.new_ledger_rows(full_ledger(spark, sf_dir), earlier_ledger(spark, sf_dir))
    return new.select("arrival_seq", "transaction_id", "proto", "version")


@query("ledger_lookup")
def ledger_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_model(spark, sf_dir).read_ledger(spark)
    row = stored.filter(F.col("transaction_id") == LOOKUP_TX)
    return row.select(*RECORD, millis("stored_at"))


@query("client_lookup")
def client_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = stored_model(spark, sf_dir).read_client_state(spark)
    return state_columns(state.filter(F.col("client_id") == LOOKUP_CLIENT))


@query("client_state_store")
def client_state_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_columns(projection.client_winners(feed_records(spark, sf_dir)))


@query("client_state_fastpath")
def client_state_fastpath(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_columns(projection.client_winners(full_ledger(spark, sf_dir)))


@query("client_state_merge")
def client_state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = feed_records(spark, sf_dir)
    first = F.col("arrival_seq") < fx.SECOND_DELIVERY
    state = projection.client_winners(recs.filter(first))
    incoming = projection.client_winners(recs.filter(~first))
    return state_columns(projection.merge_client_state(state, incoming))


def ledger_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.protocol_stats(full_ledger(spark, sf_dir))


@query("packet_stats_by_proto")
def packet_stats_by_proto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats_columns(ledger_stats(spark, sf_dir))


@query("stats_incremental_merge")
def stats_incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics stored earlier, and those of the rows that came since, merged.

    The ledger is stored in two batches by one pass over the feed; its second batch is all that the
    merge reads of it, beside the statistics stored after the first.
    """
    root = work_dir(spark, "incremental")
    schema = "proto STRING, stored_at TIMESTAMP"
    later = (F.col("arrival_ms") > fx.NOW_MS).cast("int").alias("batch_id")
    rows = full_ledger(spark, sf_dir).select("proto", "stored_at", later)
    rows.write.partitionBy("batch_id").parquet(f"{root}/ledger")
    ledger = BatchTable(f"{root}/ledger", schema)
    stored = BatchTable(f"{root}/stats", schemas.PROTOCOL_STATS)
    stored.write(stats.protocol_stats(ledger.upto(spark, 0)), 0)
    delta = stats.protocol_stats(ledger.read(spark).filter("batch_id = 1"))
    before = stored.only(spark, 0).drop("batch_id")
    return stats_columns(stats.merge_stats(before, delta))


@query("stats_protocols")
def stats_protocols(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_model(spark, sf_dir).read_stats(spark)
    return stats_columns(stats.protocols_by_count(stored))


@query("stats_clients")
def stats_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = stored_model(spark, sf_dir).read_client_state(spark)
    return state_columns(stats.latest_clients(state))


@query("stats_total")
def stats_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.total_packets(stored_model(spark, sf_dir).read_ledger(spark))


@query("fixed_window_admission")
def fixed_window_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = source(spark, sf_dir, "calls")
    decided = admission.fixed_window_admission(calls, PERMITS, WINDOW_MS)
    return decided.select("call_id", "caller", "window_start_ms", "admitted")


# --- streams -------------------------------------------------------------------------------------


def topic_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.with_headers(fx.table(fx.event_stream(spark, sf_dir), "topic_messages"))


def staged_feed(spark: SparkSession, sf_dir: str, stage: int) -> DataFrame:
    rows = fx.staged(source(spark, sf_dir, "cdc_feed"))
    return rows.filter(F.col("stage") == stage).drop("stage")


def arriving(
    spark: SparkSession, root: str, stages: Iterable[DataFrame]
) -> Iterator[DataFrame]:
    """The same folder as a stream, each time after one more stage has arrived in it."""
    for number, rows in enumerate(stages):
        rows.write.parquet(f"{root}/arriving/{number}")
        yield file_topic(spark, f"{root}/arriving", rows.schema)


def streamed_model(spark: SparkSession, sf_dir: str) -> ReadModel:
    """The read model after three micro-batches of the feed, each a folder that arrives by itself.

    Second deliveries come in the same batch or later; markers are met while they live and after
    they have expired; a later batch brings lower arrival numbers.
    """
    root = work_dir(spark, "read-model")
    model = ReadModel(root, snapshot_every=2, ledger_every=2, ledger_buckets=8)
    stages = (staged_feed(spark, sf_dir, n) for n in range(fx.STAGES))
    for feed in arriving(spark, root, stages):
        model.start(feed, f"{root}/checkpoint").awaitTermination()
    return model


def stored_model(spark: SparkSession, sf_dir: str) -> ReadModel:
    """The same tables, projected batch by batch without a stream."""
    root = work_dir(spark, "read-model")
    model = ReadModel(root, snapshot_every=2, ledger_every=2, ledger_buckets=8)
    model.create(spark)
    for stage in range(fx.STAGES):
        model.project(staged_feed(spark, sf_dir, stage), stage)
    return model


@query("stream_topic_read")
def stream_topic_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "topic-read")
    decoded = envelope_columns(routing.decode_envelope(topic_stream(spark, sf_dir)))
    sink = (
        decoded.writeStream.format("parquet")
        .option("path", f"{root}/rows")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
    )
    sink.start().awaitTermination()
    return spark.read.schema(decoded.schema).parquet(f"{root}/rows")


@query("stream_ledger")
def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = streamed_model(spark, sf_dir).read_ledger(spark)
    field = changes.payload_field(F.col("payload"), "transaction_id")
    return rows.select(*RECORD, millis("stored_at"), field.alias("payload_transaction_id"))


@query("stream_fast_path")
def stream_fast_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = streamed_model(spark, sf_dir)
    return model.read_markers(spark).select("transaction_id", "marked_at_ms")


@query("stream_client_state")
def stream_client_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_columns(streamed_model(spark, sf_dir).read_client_state(spark))


@query("stream_stats")
def stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats_columns(streamed_model(spark, sf_dir).read_stats(spark))


@query("stream_outcomes")
def stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the events of each micro-batch, as the stream tells beside its commits."""
    outcomes = streamed_model(spark, sf_dir).read_outcomes(spark)
    return outcomes.select(F.col("batch_id").alias("batch_no"), "outcome", "events")


@query("stream_dedup_state")
def stream_dedup_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger behind a filter in the state of the stream, after three micro-batches."""
    root = work_dir(spark, "seen")
    seen = SeenLedger(root, ledger_every=2, ledger_buckets=8)
    stages = (staged_feed(spark, sf_dir, n) for n in range(fx.STAGES))
    for feed in arriving(spark, root, stages):
        seen.start(feed, f"{root}/checkpoint").awaitTermination()
    field = changes.payload_field(F.col("payload"), "transaction_id")
    return seen.read(spark).select(
        *RECORD, millis("stored_at"), field.alias("payload_transaction_id")
    )


@query("stream_stats_live")
def stream_stats_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics after each of three batches, out of the state of a stream over the ledger."""
    root = work_dir(spark, "live-stats")
    model = ReadModel(f"{root}/model", snapshot_every=2, ledger_every=2, ledger_buckets=8)
    model.create(spark)
    live = LiveStats(f"{root}/live")
    rows = spark.readStream.schema(f"{model.ledger.deltas.schema}, batch_id BIGINT")
    for stage in range(fx.STAGES):
        model.project(staged_feed(spark, sf_dir, stage), stage)
        ledger = rows.parquet(model.ledger.deltas.path)
        live.start(ledger, f"{root}/checkpoint").awaitTermination()
    after = [
        live.read(spark, stage).withColumn("batch_no", F.lit(stage)) for stage in range(fx.STAGES)
    ]
    return changes.union_feeds(*after).select(
        "batch_no", "proto", "packet_count", millis("first_seen"), millis("last_seen")
    )


@query("stream_admission")
def stream_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls in three micro-batches that begin within windows."""
    root = work_dir(spark, "admission")
    limits = Admission(root, PERMITS, WINDOW_MS, snapshot_every=2)
    calls = source(spark, sf_dir, "calls")
    low, high = fx.CALL_CUTS_MS
    ts = F.col("ts_ms")
    stages = [calls.filter(c) for c in (ts < low, (ts >= low) & (ts < high), ts >= high)]
    for stream in arriving(spark, root, stages):
        limits.start(stream, f"{root}/checkpoint").awaitTermination()
    return limits.read(spark).select("call_id", "caller", "window_start_ms", "admitted")


@query("stream_pattern")
def stream_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics picked by name as a stream, some foreign, one that appears between two batches."""
    root = work_dir(spark, "pattern")
    feed = routing.change_feed(documents(spark, sf_dir)).select("topic", "value")
    messages = topic_rows(spark, sf_dir).select("msg_offset", "value")
    named = F.when(F.col("msg_offset") % 2 == 0, "pcap.tcp.pcap.packets.old").otherwise("orders")
    foreign = messages.select(named.alias("topic"), "value")
    later = F.col("topic") == "pcap.udp.pcap.packets"
    for rows in (feed.filter(~later).unionByName(foreign), feed.filter(later)):
        rows.write.mode("append").partitionBy("topic").parquet(f"{root}/topics")
        sink = (
            file_topics(spark, f"{root}/topics").writeStream.format("parquet")
            .option("path", f"{root}/rows").option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
        )
        sink.start().awaitTermination()
    return spark.read.schema("value STRING, topic STRING").parquet(f"{root}/rows")


@query("stream_bounded")
def stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic in bounded micro-batches: rows of each part, parts and rows of the batch it came in.

    A micro-batch costs a few commits, whatever it holds, so the parts are dealt out to readers that
    run side by side, each a stream with a checkpoint and a sink of its own. The sink of files puts
    the rows of a batch in place with one entry of its log, at no look at a folder; a batch is known
    by its clock, which Spark keeps in the checkpoint.
    """
    root = work_dir(spark, "bounded")
    part = F.floor(F.col("msg_offset") / fx.PART_MESSAGES).alias("part")
    reader = F.coalesce(F.pmod("part", F.lit(BOUNDED_READERS)), F.lit(0)).alias("reader")
    messages = topic_rows(spark, sf_dir).select("msg_offset", "value", part)
    tasks = messages.count() // DEALT_MESSAGES + spark.sparkContext.defaultParallelism
    dealt = messages.select("*", reader).repartition(tasks, "part")
    writer = dealt.write.options(**plain_files(spark, root)).partitionBy("reader", "part")
    writer.parquet(f"{root}/topic")
    arrived = BatchTable(f"{root}/arrived", "part BIGINT, clock BIGINT")
    sinks = [replace(arrived, path=f"{arrived.path}/{n}") for n in range(BOUNDED_READERS)]
    session = short_batches(spark, root)

    def started(number: int) -> StreamingQuery:
        topic = BatchTable(f"{root}/topic/reader={number}", "msg_offset BIGINT, value STRING")
        for table in (topic, sinks[number]):
            table.create(spark)
        stream = session.readStream.schema(f"{topic.schema}, part BIGINT")
        rows = stream.option("maxFilesPerTrigger", 1).parquet(topic.path)
        # in a lambda the clock stays out of the generated code, else compiled for each batch
        clock = F.transform(F.array(F.current_timestamp()), F.unix_millis)[0].alias("clock")
        return (
            rows.select("part", clock).writeStream.format("parquet")
            .option("path", sinks[number].path)
            .option("checkpointLocation", f"{root}/checkpoint/{number}")
            .trigger(availableNow=True).start()
        )

    streams = []
    with bare_settings(spark):
        try:
            for number in range(BOUNDED_READERS):
                streams.append(started(number))
            for stream in streams:
                stream.awaitTermination()
        finally:  # an error of one ends the others
            for stream in streams:
                stream.stop()
    stored = [
        spark.read.schema(sink.schema).parquet(sink.path).withColumn("reader", F.lit(number))
        for number, sink in enumerate(sinks)
    ]
    found = (
        changes.union_feeds(*stored).groupBy("reader", "clock", "part")
        .agg(F.count("*").alias("messages"))
    )
    of_batch = Window.partitionBy("reader", "clock")
    return found.select(
        "part", "messages", F.count("*").over(of_batch).alias("parts_in_batch"),
        F.sum("messages").over(of_batch).alias("messages_in_batch"),
    )


@query("stream_relay")
def stream_relay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outbox rows that arrive by and by, sent by two checkpoints one after the other."""
    root = work_dir(spark, "relay")
    rows = source(spark, sf_dir, "outbox_table")
    later = F.expr(fx.ADDED_LATER)
    stages = arriving(spark, root, (rows.filter(~later), rows.filter(later)))
    for checkpoint, stream in zip(("one", "two"), stages, strict=True):
        start_relay(stream, f"{root}/published", f"{root}/{checkpoint}").awaitTermination()
    sent = read_published(spark, f"{root}/published")
    return sent.select("id", "topic", "key", "value", "partition_id", "error")


@query("relay_ticks")
def relay_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ticks over a stored outbox: sent, failed, and sent after the lease ran out."""
    root = work_dir(spark, "outbox")
    stored = StoredOutbox(root)
    stored.load(fx.some_blank_topics(source(spark, sf_dir, "outbox_table")))
    published = published_table(f"{root}/published")
    published.create(spark)

    def sent_in(number: int) -> Callable[[DataFrame], None]:
        return lambda messages: published.write(relay.with_partition(messages), number)

    def unreachable(messages: DataFrame) -> None:
        raise ConnectionError("no broker")

    for number, (after, send) in enumerate(
        ((0, sent_in(0)), (1_000, unreachable), (30_000, sent_in(2)))
    ):
        with contextlib.suppress(ConnectionError):
            stored.tick(spark, number, fx.NOW_MS + after, send)
    sent = published.read(spark).select("id", F.col("batch_id").alias("sent_in"))
    fields = ["id", "is_processed", "is_processing", "reserved_at_ms", "expired_at_ms"]
    return stored.read(spark).select(*fields).join(sent, "id", "left")


@query("relay_workers")
def relay_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four workers share an outbox to which rows are added between their ticks."""
    root = work_dir(spark, "workers")
    stored = StoredOutbox(root, snapshot_every=2, workers=WORKERS)
    published = BatchTable(f"{root}/published", "id STRING, worker INT, tick INT")
    rows = source(spark, sf_dir, "outbox_table")
    later = F.expr(fx.ADDED_LATER)
    stored.load(rows.filter(~later))
    published.create(spark)
    for tick in range(3):
        for worker in range(WORKERS):

            def send(messages: DataFrame, tick: int = tick, worker: int = worker) -> None:
                sent = messages.select(
                    "id", F.lit(worker).alias("worker"), F.lit(tick).alias("tick")
                )
                published.write(sent, tick * WORKERS + worker)

            now = fx.NOW_MS + 1000 * tick
            stored.tick(spark, tick, now, send, limit=WORKER_LIMIT, worker=worker)
        if tick == 0:
            stored.append(rows.filter(later))
    return published.read(spark).drop("batch_id")


def routed_sinks(spark: SparkSession, router: Router) -> DataFrame:
    """What the router has stored, one row for each document, retry, dead letter and refusal."""

    def sink(df: DataFrame, name: str, key: str, detail: str) -> DataFrame:
        return df.select(
            F.lit(name).alias("sink"),
            F.col(key).cast("string").alias("item"),
            F.col(detail).cast("string").alias("detail"),
        )

    return changes.union_feeds(
        sink(router.stored(spark, router.shards), "shard", "packet_id", "shard"),
        sink(router.stored(spark, router.retries), "retry", "msg_offset", "attempts"),
        sink(router.stored(spark, router.dead_letters), "dead_letter", "origin_msg_offset",
             "attempts"),
        sink(router.stored(spark, router.refused), "refused", "msg_offset", auth.HASH),
    )


@query("stream_route")
def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic that arrives in two parts, routed by two checkpoints; the second reads all of it."""
    root = work_dir(spark, "route")
    router = Router(root, valid_keys=VALID_KEYS, down_shards=DOWN)
    messages = topic_rows(spark, sf_dir)
    first = F.col("msg_offset") % 4 > 0
    stages = arriving(spark, root, (messages.filter(first), messages.filter(~first)))
    for checkpoint, stream in zip(("one", "two"), stages, strict=True):
        router.start(stream, f"{root}/{checkpoint}").awaitTermination()
    return routed_sinks(spark, router)


@query("stream_merged_shards")
def stream_merged_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each shard and its change events, while batches are merged between them."""
    root = work_dir(spark, "merged")
    router = Router(root, valid_keys=VALID_KEYS, down_shards=DOWN)
    router.create(spark)
    merged = MergedShards(router.shards.path)
    messages = topic_rows(spark, sf_dir)
    events = None
    for stage in range(4):
        router.route(messages.filter(F.col("msg_offset") % 4 == stage), stage)
        feed = shard_change_stream(spark, router.shards.path).select("topic", "shard", "value")
        events = feed.schema
        sink = (
            feed.writeStream.format("parquet").option("path", f"{root}/events")
            .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
        )
        sink.start().awaitTermination()
        if stage < 3:
            merged.merge(spark, router.commits.last(spark))
    documents = merged.read(spark, router.commits.last(spark))
    told = spark.read.schema(events).parquet(f"{root}/events")
    return routing.shard_counts(documents).join(
        told.groupBy("shard").agg(F.count("*").alias("events")), "shard", "full"
    )


class BreaksOnce(Router):
    """Goes away during its first batch: dead letters are not written, other sinks are."""

    up: ClassVar[dict[str, bool]] = {}

    def route(self, batch: DataFrame, stream_batch: int, writer: str = "") -> None:
        first = self.root not in self.up
        self.up[self.root] = not first
        try:
            super().route(batch, stream_batch, writer)
        finally:
            self.up[self.root] = True

    @property
    def dead_letters(self) -> BatchTable:
        if not self.up.get(self.root, True):
            raise TargetUnreachable("the connection was lost")
        return super().dead_letters


@query("stream_unreachable")
def stream_unreachable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store goes away between two sinks of a batch; the stream is started again."""
    root = work_dir(spark, "unreachable")
    router = BreaksOnce(root, valid_keys=VALID_KEYS, down_shards=DOWN)
    for attempt in range(2):
        stream = router.start(topic_stream(spark, sf_dir), f"{root}/checkpoint")
        if attempt:
            stream.awaitTermination()
        else:
            with contextlib.suppress(StreamingQueryException):
                stream.awaitTermination()
                raise RuntimeError("the store did not go away")
    return routed_sinks(spark, router)


@query("stream_retry_to_dead_letter")
def stream_retry_to_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retries go back into the folder the stream reads, until all tries are used up."""
    root = work_dir(spark, "retry")
    topic = f"{root}/topic"
    router = Router(root, retry_path=f"{topic}/retries", allow_anyone=True, down_shards=DOWN)
    topic_rows(spark, sf_dir).write.parquet(f"{topic}/first")
    for _ in range(router.max_attempts):
        stream = file_topic(spark, topic)
        router.start(stream, f"{root}/checkpoint").awaitTermination()
    dead = router.stored(spark, router.dead_letters)
    return dead.select(
        F.col("origin_msg_offset").alias("msg_offset"), "key", "value", "attempts"
    )
