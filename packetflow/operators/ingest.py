"""Packet intake: requests become snapshots, and a count goes back to the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetflow.functions import is_blank, stable_id
from packetflow.operators.ranking import number_within

#: Fixed value: the client of a packet without a source address.
UNKNOWN_CLIENT = "unknown"

#: Fixed value: packets of one call stored together.
INTAKE_BATCH = 100


def ingest_packets(
    requests: DataFrame, ingest_ms: Column, coordinates: Sequence[Column]
) -> DataFrame:
    """Add id, client and version to packet requests, batch or stream.

    ``coordinates`` say where a request came from and identify it; the id is made from them.
    """
    client = F.when(is_blank(F.col("source_ip")), F.lit(UNKNOWN_CLIENT)).otherwise(
        F.col("source_ip")
    )
    return requests.withColumns(
        {
            "transaction_id": stable_id(*coordinates),
            "client_id": client,
            "version": ingest_ms.cast("bigint"),
        }
    )


def accepted_counts(requests: DataFrame, call: str) -> DataFrame:
    """How many packets each call had stored; every request of a stream is."""
    return requests.groupBy(call).agg(F.count("*").alias("accepted"))


def intake_batches(
    requests: DataFrame, call: str, order: str, size: int = INTAKE_BATCH
) -> DataFrame:
    """Add ``batch_no``: the packets of a call, in order, in batches of ``size``, from 0."""
    numbered = number_within(requests, [call], order, "__position")
    batch_no = F.floor((F.col("__position") - 1) / F.lit(size)).cast("bigint")
    return numbered.withColumn("batch_no", batch_no).drop("__position")
