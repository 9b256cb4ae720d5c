"""Change events of the shards, parsed into records or given a reason to skip them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetflow.functions import evaluate_once, is_blank, stored_at, stored_at_usable, with_object
from packetflow.functions.json import READ_OPTIONS, bad_number, is_nested

#: Fields of a flattened change event.
TEXT_FIELDS = ("__op", "transaction_id", "client_id", "proto", "source_ip", "dest_ip")
NUMBER_FIELDS = {"version": "bigint", "source_port": "int", "dest_port": "int"}
TIME_FIELD = "storedAt"

#: Fixed value: protocol of an event that names none.
DEFAULT_PROTO = "OTHER"

#: Columns of a record, in ledger order, without the payload.
RECORD_COLUMNS = (
    "transaction_id", "client_id", "version", "proto", "source_ip", "dest_ip",
    "source_port", "dest_port", "stored_at",
)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """The feeds of several shards as one."""
    return reduce(lambda a, b: a.unionByName(b), feeds)


def _skip_reason(value: Column, record: Column) -> Column:
    texts = {name: record[name] for name in TEXT_FIELDS}
    bad_numbers = [bad_number(record[name], kind) for name, kind in NUMBER_FIELDS.items()]
    ill_typed = reduce(
        lambda a, b: a | b,
        [*bad_numbers, ~stored_at_usable(record[TIME_FIELD]), is_nested(value, texts)],
    )
    key = {name: record[name] for name in ("__op", "transaction_id")}
    unreadable = F.when(is_blank(value), "tombstone").otherwise("malformed")
    return (
        F.when(record.isNull(), unreadable)
        .when(record["__op"] == "d", "delete")
        .when(is_nested(value, key), "bad_type")
        .when(is_blank(record["transaction_id"]), "no_key")
        .when(ill_typed, "bad_type")
    )


def parse_changes(feed: DataFrame, value: str = "value") -> DataFrame:
    """Every event of the feed, with ``skip_reason`` null if it is a record to project.

    Reasons: ``tombstone`` (no value), ``malformed`` (not one JSON object), ``delete``, ``no_key``
    (no business key), ``bad_type`` (a field no record can be made of; for a quarantine). Each
    document is read and typed once, whatever is filtered on afterwards.
    """
    types = [f"`{name}` string" for name in (*TEXT_FIELDS, *NUMBER_FIELDS)]
    fields = ", ".join([*types, f"`{TIME_FIELD}` variant"])
    read = with_object(feed, F.col(value), fields, "__rec")
    rec = F.col("__rec")

    def text(name: str, default: str) -> Column:
        return F.coalesce(rec[name], F.lit(default)).alias(name)

    numbers = {
        name: F.coalesce(rec[name].try_cast(kind), F.lit(0).cast(kind)).alias(name)
        for name, kind in NUMBER_FIELDS.items()
    }
    typed = F.struct(
        _skip_reason(F.col(value), rec).alias("skip_reason"),
        rec["transaction_id"].alias("transaction_id"),
        text("client_id", ""),
        numbers["version"],
        text("proto", DEFAULT_PROTO),
        text("source_ip", ""),
        text("dest_ip", ""),
        numbers["source_port"],
        numbers["dest_port"],
        stored_at(rec[TIME_FIELD]).alias("stored_at"),
    )
    once = evaluate_once(read, typed, "__typed")
    columns = ("skip_reason", *RECORD_COLUMNS)
    return once.select(*feed.columns, *[F.col("__typed")[c].alias(c) for c in columns])


def records(parsed: DataFrame) -> DataFrame:
    """The events to project."""
    return parsed.filter(F.col("skip_reason").isNull()).drop("skip_reason")


def quarantined(parsed: DataFrame) -> DataFrame:
    """Events with a field of the wrong type, for someone to look at."""
    return parsed.filter(F.col("skip_reason") == "bad_type")


def skipped_counts(parsed: DataFrame) -> DataFrame:
    """Events not projected, by reason."""
    skipped = parsed.filter(F.col("skip_reason").isNotNull())
    return skipped.groupBy("skip_reason").agg(F.count("*").alias("events"))


def with_payload(recs: DataFrame, value: str = "value") -> DataFrame:
    """Add the whole document as VARIANT, fields without a column of their own included."""
    return recs.withColumn("payload", F.from_json(F.col(value), "variant", READ_OPTIONS))


def payload_field(payload: Column, field: str) -> Column:
    """A top-level field of the payload as text."""
    return F.try_variant_get(payload, f"$.{field}", "string")
