"""Statistics of the ledger and the reads served from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: clients listed.
CLIENT_LIMIT = 100


def protocol_stats(ledger: DataFrame) -> DataFrame:
    """Packets and time bounds per protocol, as named in the packet: TLS is not HTTPS here."""
    return ledger.groupBy("proto").agg(
        F.count("*").alias("packet_count"),
        F.min("stored_at").alias("first_seen"),
        F.max("stored_at").alias("last_seen"),
    )


def merge_stats(*parts: DataFrame) -> DataFrame:
    """Statistics of all parts together; reads the parts, not the ledger behind them."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("proto").agg(
        F.sum("packet_count").alias("packet_count"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )


def protocols_by_count(stats: DataFrame) -> DataFrame:
    """Busiest protocol first."""
    return stats.orderBy(F.col("packet_count").desc(), F.col("proto").asc())


def latest_clients(state: DataFrame, limit: int = CLIENT_LIMIT) -> DataFrame:
    """Clients whose state changed last."""
    return state.orderBy(F.col("updated_at_ms").desc(), F.col("client_id").asc()).limit(limit)


def total_packets(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count("*").alias("total_packets"))
