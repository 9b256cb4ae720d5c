"""Routing of topic messages to shards, with retry and dead letter for those refused."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetflow.functions import (
    attempt_count,
    classify_protocol,
    evaluate_once,
    is_blank,
    is_iso_time,
    retry_headers,
    split_lines,
    stable_id,
    strict_object,
    with_record,
)
from packetflow.functions.json import bad_number, closes_itself, is_nested, parse_object

# Tries of a message in total, topics, and the reason given with a dead letter.
MAX_ATTEMPTS = 3
MAIN_TOPIC = "SnapshotTopic"
DEAD_LETTER_TOPIC = "deadletter"
MAX_ATTEMPTS_REASON = "max attempts exceeded"

# Fields of the envelope and of the snapshot inside.
ENVELOPE_FIELDS = (
    "Topic string, Key string, Payload variant, PayloadType string, "
    "Metadata variant, Created string"
)
ENVELOPE_TEXTS = ("Topic", "Key", "PayloadType", "Created")
SNAPSHOT_TEXTS = (
    "transaction_id", "client_id", "source_ip", "dest_ip", "source_mac", "dest_mac", "proto",
)
SNAPSHOT_NUMBERS = {"version": "bigint", "source_port": "int", "dest_port": "int"}
SNAPSHOT_FIELDS = ", ".join(f"{f} string" for f in (*SNAPSHOT_TEXTS, *SNAPSHOT_NUMBERS))

SETTLED = "settled"
REJECTED = "rejected"

COORDINATES = ("topic", "msg_partition", "msg_offset")


def decode_envelope(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``envelope``, null if the message value is no well-formed envelope.

    The payload is a string that holds JSON. It is read as VARIANT to tell such a string from an
    object put there without quotes, which is malformed; so is metadata that is no object.
    """
    read = with_record(messages, F.col(value), ENVELOPE_FIELDS, "__raw")
    raw = F.col("__raw")
    bad_time = raw["Created"].isNotNull() & ~is_iso_time(raw["Created"])
    bad_payload = F.schema_of_variant(raw["Payload"]).rlike("^(OBJECT|ARRAY)")
    bad_text = is_nested(F.col(value), {name: raw[name] for name in ENVELOPE_TEXTS})
    metadata = F.try_variant_get(raw["Metadata"], "$", "map<string,string>")
    given = raw["Metadata"].isNotNull() & ~F.is_variant_null(raw["Metadata"])
    bad = bad_time | F.coalesce(bad_payload, F.lit(False)) | bad_text | (given & metadata.isNull())
    good = raw.isNotNull() & ~bad
    envelope = F.struct(
        *[raw[n].alias(n) for n in ENVELOPE_TEXTS],
        metadata.alias("Metadata"),
        F.try_variant_get(raw["Payload"], "$", "string").alias("Payload"),
    )
    return read.withColumn("envelope", F.when(good, envelope)).drop("__raw")


def _well_typed(line: Column, snapshot: Column) -> Column:
    """True if the fields of a snapshot are of their types."""
    numbers = [bad_number(snapshot[name], kind) for name, kind in SNAPSHOT_NUMBERS.items()]
    texts = is_nested(line, {name: snapshot[name] for name in SNAPSHOT_TEXTS})
    return snapshot.isNotNull() & ~reduce(lambda a, b: a | b, [*numbers, texts])


def read_line(line: Column) -> Column:
    """A snapshot struct from one line of a payload, null if it is none.

    Fields stay text here; numbers are cast where documents are built.
    """
    return F.try_element_at(strict_object(line, SNAPSHOT_FIELDS), F.lit(1))


def classify_payload(df: DataFrame, payload: str, name: str = "protocol") -> DataFrame:
    """Add the protocol class of a JSON payload; one that cannot be read is OTHER."""
    read = with_record(df, F.col(payload), SNAPSHOT_FIELDS, "__snap")
    snap = F.col("__snap")
    proto = F.when(_well_typed(F.col(payload), snap), snap["proto"])
    return read.withColumn(name, classify_protocol(proto)).drop("__snap")


def _line(snapshot: Column) -> Column:
    """A line as stored: its snapshot, null if unreadable, and its shard."""
    return F.struct(snapshot.alias("snapshot"), classify_protocol(snapshot["proto"]).alias("shard"))


def _with_lines(messages: DataFrame, payload: Column) -> DataFrame:
    """Add ``lines``, null for a blank payload.

    Almost every payload is one line. That case is kept out of lambdas, which Spark interprets; only
    payloads of several lines go through them.
    """
    texts, only, several = F.col("__texts"), F.col("__only"), F.size("__texts") > 1
    split = messages.withColumn("__texts", F.when(~is_blank(payload), split_lines(payload)))
    parsed = split.withColumn("__only", F.when(F.size("__texts") == 1, texts[0])).select(
        "*",
        parse_object(only, SNAPSHOT_FIELDS).alias("__parsed"),
        closes_itself(only).alias("__loose"),
        F.when(several, F.transform(texts, read_line)).alias("__many"),
    )
    whole = (F.size("__parsed") == 1) & ~F.col("__loose")
    single = parsed.withColumn("__single", F.when(whole, F.col("__parsed")[0]))
    checked = single.withColumn(
        "__single", F.when(_well_typed(only, F.col("__single")), F.col("__single"))
    )

    def checked_line(text: Column, snapshot: Column) -> Column:
        return _line(F.when(_well_typed(text, snapshot), snapshot))

    lines = (
        F.when(texts.isNull(), F.lit(None))
        .when(several, F.zip_with(texts, F.col("__many"), checked_line))
        .otherwise(F.array(_line(F.col("__single"))))
    )
    return evaluate_once(checked, lines, "lines").drop(
        "__texts", "__only", "__parsed", "__loose", "__many", "__single"
    )


def _any_line(lines: Column, test: Callable[[Column], Column]) -> Column:
    return F.when(F.size(lines) == 1, test(lines[0])).otherwise(F.exists(lines, test))


def route(messages: DataFrame, down_shards: Sequence[str] = ()) -> DataFrame:
    """Every message with its ``lines``, ``verdict``, ``reason`` and ``attempts``.

    ``lines`` holds, for each line of the payload, the snapshot (null if unreadable) and its shard.
    A message is settled if its payload is blank or all its lines can be stored, and rejected if
    the envelope or a line is malformed or a shard it needs is down. Nothing is shuffled.
    """
    decoded = decode_envelope(messages)
    routed = _with_lines(decoded, F.col("envelope")["Payload"])
    lines = F.col("lines")
    malformed = _any_line(lines, lambda line: line["snapshot"].isNull())
    down = F.lit(False)
    if down_shards:
        down = _any_line(lines, lambda line: line["shard"].isin(*down_shards))
    reason = (
        F.when(F.col("envelope").isNull(), "malformed_envelope")
        .when(lines.isNull(), "empty_payload")
        .when(malformed, "malformed_payload")
        .when(down, "shard_down")
        .otherwise("stored")
    )
    settled = F.col("reason").isin("empty_payload", "stored")
    return (
        routed.withColumn("reason", reason)
        .withColumn("verdict", F.when(settled, SETTLED).otherwise(REJECTED))
        .withColumn("attempts", attempt_count(F.col("headers")))
        .drop("envelope")
    )


def shard_documents(
    routed: DataFrame, stored_at_ms: Column, down_shards: Sequence[str] = ()
) -> DataFrame:
    """The documents to store: one per readable line whose shard is up.

    A blank transaction id is replaced by one made from the coordinates of the message, so a
    replay makes the same one. A blank client id becomes the source address.
    """
    items = routed.select(
        *COORDINATES, stored_at_ms.alias("stored_at_ms"), F.posexplode("lines").alias("no", "one")
    )
    snap, shard = F.col("one")["snapshot"], F.col("one")["shard"]
    good = items.filter(snap.isNotNull())
    if down_shards:
        good = good.filter(~shard.isin(*down_shards))
    place = [*(F.col(c) for c in COORDINATES), F.col("no")]

    def text(name: str) -> Column:
        return F.coalesce(snap[name], F.lit(""))

    def number(name: str) -> Column:
        kind = SNAPSHOT_NUMBERS[name]
        return F.coalesce(snap[name].try_cast(kind), F.lit(0).cast(kind))

    tx, client = snap["transaction_id"], snap["client_id"]
    return good.select(
        *COORDINATES,
        F.when(is_blank(tx), stable_id(*place)).otherwise(tx).alias("transaction_id"),
        F.when(is_blank(client), text("source_ip")).otherwise(client).alias("client_id"),
        number("version").alias("version"),
        number("source_port").alias("source_port"),
        number("dest_port").alias("dest_port"),
        *[text(f).alias(f) for f in ("source_ip", "dest_ip", "source_mac", "dest_mac", "proto")],
        stable_id(F.lit("packet"), *place).alias("packet_id"),
        F.col("no").alias("line_no"),
        "stored_at_ms",
        shard.alias("shard"),
    )


def shard_counts(documents: DataFrame) -> DataFrame:
    return documents.groupBy("shard").agg(F.count("*").alias("documents"))


def _resent(routed: DataFrame, topic: str, attempts: Column, headers: Column) -> DataFrame:
    """Key and value unchanged; a missing key is made from the coordinates."""
    key = F.coalesce(F.col("msg_key"), stable_id(*[F.col(c) for c in COORDINATES]))
    return routed.select(
        F.lit(topic).alias("topic"),
        key.alias("key"),
        "value",
        headers.alias("headers"),
        attempts.alias("attempts"),
        *[F.col(c).alias(f"origin_{c}") for c in (*COORDINATES, "msg_ts_ms", "api_key_hash")],
    )


def retry_messages(
    routed: DataFrame, topic: str = MAIN_TOPIC, max_attempts: int = MAX_ATTEMPTS
) -> DataFrame:
    """Rejected messages with tries left, for the topic they came from."""
    tried = F.col("attempts") + 1
    again = routed.filter((F.col("verdict") == REJECTED) & (tried < max_attempts))
    return _resent(again, topic, tried, retry_headers(tried))


def dead_letters(
    routed: DataFrame, topic: str = DEAD_LETTER_TOPIC, max_attempts: int = MAX_ATTEMPTS
) -> DataFrame:
    """Rejected messages that have used up their tries."""
    tried = F.col("attempts") + 1
    dead = routed.filter((F.col("verdict") == REJECTED) & (tried >= max_attempts))
    return _resent(dead, topic, tried, retry_headers(tried, MAX_ATTEMPTS_REASON))


def change_feed(documents: DataFrame, prefix: str = "pcap") -> DataFrame:
    """Change events of stored documents: the document and its operation, a topic per shard.

    Shards only ever get inserts, so every event is a create. Where documents know the message they
    came from, the events keep its place as their order.
    """
    fields = (
        "packet_id", "transaction_id", "client_id", "version", "source_port", "dest_port",
        "source_ip", "dest_ip", "source_mac", "dest_mac", "proto",
    )
    document = F.struct(
        F.lit("c").alias("__op"),
        *[F.col(f).alias("packetId" if f == "packet_id" else f) for f in fields],
        F.col("stored_at_ms").alias("storedAt"),
    )
    topic = F.concat(F.lit(f"{prefix}."), F.lower("shard"), F.lit(f".{prefix}.packets"))
    place = []
    if "msg_offset" in documents.columns:
        place = [
            F.col("msg_offset").alias("arrival_seq"),
            F.col("stored_at_ms").alias("arrival_ms"),
            "msg_partition",
            "line_no",
        ]
    return documents.select(
        topic.alias("topic"),
        "shard",
        F.to_json(document, {"ignoreNullFields": "false"}).alias("value"),
        *place,
    )


#: Fixed value: the topics the read side subscribes to.
CHANGE_TOPICS = r"^pcap\..*packets$"


def matching_topics(feed: DataFrame, pattern: str = CHANGE_TOPICS) -> DataFrame:
    """Messages of all topics whose name matches."""
    return feed.filter(F.col("topic").rlike(pattern))
