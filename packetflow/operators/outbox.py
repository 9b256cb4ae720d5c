"""The outbox: rows wait here until a relay has published them.

A claim holds a row for the length of a lease. A row whose lease has run out can be claimed again,
so nothing is lost with a worker that died.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetflow.functions import hash_slot, stable_id
from packetflow.operators.joins import MAX_BROADCAST_KEYS
from packetflow.session import prepare

# Rows per claim and length of its lease.
CLAIM_LIMIT = 100
LEASE_MS = 20_000

#: Fixed value: name of the record type a snapshot is stored under.
SNAPSHOT_TYPE = "SnapshotMessage"

SNAPSHOT_FIELDS = (
    "transaction_id", "client_id", "version", "source_port", "dest_port",
    "source_ip", "dest_ip", "source_mac", "dest_mac", "proto",
)


def outbox_rows(
    df: DataFrame,
    topic: str,
    created_ms: Column,
    fields: Sequence[str] = SNAPSHOT_FIELDS,
    message_type: str = SNAPSHOT_TYPE,
    partition_by: Column | None = None,
    metadata: Column | None = None,
    is_sequential: bool = False,
    coordinates: Sequence[Column] = (),
) -> DataFrame:
    """Outbox rows for records: the record as JSON, with topic, key and metadata beside it.

    ``partition_by`` is any column expression, ``metadata`` a ``map<string,string>``. The id is
    made from ``coordinates``, by default the first field, or all fields where that is null.
    """
    keep_nulls = {"ignoreNullFields": "false"}
    text = F.lit(None).cast("string")
    kind = F.lit("outbox")
    if coordinates:
        row_id = stable_id(kind, *coordinates)
    else:
        unnamed = stable_id(kind, *[F.col(f) for f in fields])
        row_id = F.when(F.col(fields[0]).isNull(), unnamed).otherwise(
            stable_id(kind, F.col(fields[0]))
        )
    return df.select(
        row_id.alias("id"),
        created_ms.cast("bigint").alias("date_timestamp_ms"),
        F.to_json(F.struct(*fields), keep_nulls).alias("raw_data"),
        F.lit(message_type).alias("message_type"),
        F.lit(topic).alias("topic"),
        (text if partition_by is None else partition_by).alias("partition_by"),
        F.lit(0).alias("is_processed"),
        F.lit(int(is_sequential)).alias("is_sequential"),
        (text if metadata is None else F.to_json(metadata)).alias("metadata"),
        F.lit(None).cast("bigint").alias("reserved_at_ms"),
        F.lit(None).cast("bigint").alias("expired_at_ms"),
        F.lit(0).alias("is_processing"),
    )


def eligible(outbox: DataFrame, now_ms: int) -> DataFrame:
    """Rows a relay may claim at ``now_ms``: pending, unordered, and free or abandoned."""
    free = (F.col("is_processing") == 0) | (
        (F.col("is_processing") == 1) & (F.col("expired_at_ms") <= F.lit(now_ms))
    )
    return outbox.filter((F.col("is_processed") == 0) & (F.col("is_sequential") == 0) & free)


def _claimed(rows: DataFrame, now_ms: int, lease_ms: int) -> DataFrame:
    return rows.withColumns(
        {
            "is_processing": F.lit(1),
            "reserved_at_ms": F.lit(now_ms).cast("bigint"),
            "expired_at_ms": F.lit(now_ms + lease_ms).cast("bigint"),
        }
    )


def reserve(
    outbox: DataFrame, now_ms: int, limit: int = CLAIM_LIMIT, lease_ms: int = LEASE_MS
) -> DataFrame:
    """Claim the oldest rows. Ties are broken by id, so a replay claims the same ones.

    Plans as a top-n: each task keeps its ``limit`` best rows. For claims too large for one task
    share the work with :func:`worker_claims`.
    """
    oldest = eligible(outbox, now_ms).orderBy("date_timestamp_ms", "id").limit(limit)
    return _claimed(oldest, now_ms, lease_ms)


def worker_claims(
    outbox: DataFrame,
    now_ms: int,
    workers: int,
    limit: int = CLAIM_LIMIT,
    lease_ms: int = LEASE_MS,
) -> DataFrame:
    """Claims of several workers at once: each takes the oldest rows of its own share of ids.

    The shares are disjoint by construction, so workers need no locks to stay apart. Each map task
    sends on ``limit`` rows of a worker at most, whatever the limit.
    """
    prepare(outbox.sparkSession)
    window = Window.partitionBy("worker").orderBy("date_timestamp_ms", "id")
    ranked = (
        eligible(outbox, now_ms)
        .withColumn("worker", hash_slot(F.col("id"), workers))
        .withColumn("claim_rank", F.row_number().over(window))
        .filter(F.col("claim_rank") <= limit)
    )
    return _claimed(ranked, now_ms, lease_ms)


def claim_audit(claims: DataFrame) -> DataFrame:
    """Claims and distinct rows claimed; they differ if a row was claimed twice."""
    return claims.agg(
        F.count("id").alias("claimed"), F.count_distinct("id").alias("distinct_claimed")
    )


def _flagged(outbox: DataFrame, ids: DataFrame, max_ids: int | None) -> DataFrame:
    """The outbox with ``__hit`` true on given ids, which are unique on both sides."""
    marked = ids.select("id").withColumn("__hit", F.lit(True))
    if max_ids is not None and max_ids <= MAX_BROADCAST_KEYS:
        marked = F.broadcast(marked)
    return outbox.join(marked, "id", "left")


def mark_processed(outbox: DataFrame, ids: DataFrame, max_ids: int | None = None) -> DataFrame:
    """The outbox after the rows of ``ids`` were published.

    ``max_ids`` is a bound on them the caller knows, such as the limit of the claim.
    """
    done = F.when(F.col("__hit"), F.lit(1)).otherwise(F.col("is_processed"))
    return _flagged(outbox, ids, max_ids).withColumn("is_processed", done).drop("__hit")


def apply_claims(outbox: DataFrame, claims: DataFrame, max_ids: int | None = None) -> DataFrame:
    """The outbox with the claim fields of claimed rows written back."""
    fields = ["is_processing", "reserved_at_ms", "expired_at_ms"]
    update = claims.select("id", F.lit(True).alias("__hit"), F.struct(*fields).alias("__claim"))
    if max_ids is not None and max_ids <= MAX_BROADCAST_KEYS:
        update = F.broadcast(update)
    joined = outbox.join(update, "id", "left")
    changed = {f: F.when(F.col("__hit"), F.col("__claim")[f]).otherwise(F.col(f)) for f in fields}
    return joined.withColumns(changed).select(*outbox.columns)


def cleanup(outbox: DataFrame) -> DataFrame:
    """The outbox without rows already published."""
    return outbox.filter(F.col("is_processed") == 0)
