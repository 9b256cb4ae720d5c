"""Projection of records into ledger and client state, the same however often they are delivered.

Order is arrival order, ``arrival_seq``. A record goes past a fast path of recently seen
transactions, then is added to the ledger unless its transaction is there, and then moves the
state of its client forward if its version is higher.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetflow.operators.joins import without_stored
from packetflow.operators.ranking import best_per_key

#: Fixed value: a marker lives seven days.
MARKER_TTL_MS = 7 * 24 * 3600 * 1000

# What becomes of an event.
SKIPPED = "Skipped"
FAST_PATH_SKIP = "FastPathSkip"
PROJECTED = "Projected"
DUPLICATE = "Duplicate"


#: What tells events of one ``arrival_seq`` apart, where a feed has it.
TIES = ("topic", "msg_partition", "line_no")


def arrival_order(recs: DataFrame) -> list[Column]:
    return [F.col(c).asc() for c in ("arrival_seq", *TIES) if c in recs.columns]


def first_arrivals(recs: DataFrame) -> DataFrame:
    """The first record of each transaction; later ones never change it."""
    return best_per_key(recs, ["transaction_id"], arrival_order(recs))


def new_ledger_rows(
    firsts: DataFrame, ledger: DataFrame, batch_rows: int | None = None
) -> DataFrame:
    """First arrivals whose transaction the ledger does not hold yet."""
    return without_stored(firsts, ledger, "transaction_id", batch_rows)


def live_markers(markers: DataFrame, now_ms: int, ttl_ms: int = MARKER_TTL_MS) -> DataFrame:
    """Markers not expired at ``now_ms``."""
    return markers.filter(F.col("marked_at_ms") > F.lit(now_ms - ttl_ms))


def fast_path(
    firsts: DataFrame,
    markers: DataFrame,
    now_ms: int,
    ttl_ms: int = MARKER_TTL_MS,
    batch_rows: int | None = None,
) -> DataFrame:
    """First arrivals that no live marker knows: the records that reach the store.

    Later deliveries of a batch would be stopped by the marker of the first, so only first
    arrivals are looked up, and no key is looked up twice.
    """
    live = live_markers(markers, now_ms, ttl_ms)
    return without_stored(firsts, live, "transaction_id", batch_rows)


def update_markers(
    markers: DataFrame, stored: DataFrame, now_ms: int, ttl_ms: int = MARKER_TTL_MS
) -> DataFrame:
    """Markers after ``stored`` transactions were marked at ``now_ms``; expired ones are gone."""
    fresh = stored.select("transaction_id", F.lit(now_ms).cast("bigint").alias("marked_at_ms"))
    merged = markers.select("transaction_id", "marked_at_ms").unionByName(fresh)
    return live_markers(fold_markers(merged), now_ms, ttl_ms)


def fold_markers(versions: DataFrame) -> DataFrame:
    """The latest marker of each transaction."""
    return versions.groupBy("transaction_id").agg(F.max("marked_at_ms").alias("marked_at_ms"))


def client_winners(recs: DataFrame) -> DataFrame:
    """State of each client after these records: the highest version, on a tie the earliest."""
    order = [F.col("version").desc(), *arrival_order(recs)]
    return best_per_key(recs, ["client_id"], order).select(
        "client_id",
        "version",
        F.col("proto").alias("last_proto"),
        F.col("arrival_ms").alias("updated_at_ms"),
        "arrival_seq",
    )


def merge_client_state(state: DataFrame, incoming: DataFrame) -> DataFrame:
    """State after later winners: a client moves only to a strictly higher version.

    Both sides have the columns of :func:`client_winners`; what is in ``state`` arrived before.
    """
    both = state.withColumn("__later", F.lit(0)).unionByName(
        incoming.withColumn("__later", F.lit(1))
    )
    order = [F.col("version").desc(), F.col("__later").asc(), F.col("arrival_seq").asc()]
    return best_per_key(both, ["client_id"], order).drop("__later")


def fold_client_state(versions: DataFrame) -> DataFrame:
    """State from any number of winners per client, each with the number of its batch.

    Of equal versions the one of the earlier batch stays, as if the batches had come one by one; a
    later batch may well bring a lower offset, of another partition.
    """
    order = [F.col("version").desc(), F.col("batch_no").asc(), F.col("arrival_seq").asc()]
    return best_per_key(versions, ["client_id"], order)


def outcome_counts(
    parsed: DataFrame,
    markers: DataFrame,
    ledger: DataFrame,
    now_ms: int,
    ttl_ms: int = MARKER_TTL_MS,
) -> DataFrame:
    """Events by outcome, for a batch that meets these markers and this ledger.

    Deliveries are counted per transaction before anything is joined, so the joins see each
    transaction once, however often it was delivered. Skipped events are the group without one.
    """
    tx = F.when(F.col("skip_reason").isNull(), F.col("transaction_id")).alias("transaction_id")
    deliveries = parsed.groupBy(tx).agg(F.count("*").alias("n"))
    seen = live_markers(markers, now_ms, ttl_ms).groupBy("transaction_id").agg(
        F.lit(True).alias("seen")
    )
    stored = ledger.select("transaction_id", F.lit(True).alias("stored"))

    def outcome(name: str, count: Column) -> Column:
        return F.struct(F.lit(name).alias("outcome"), count.cast("bigint").alias("n"))

    n, later = F.col("n"), F.col("n") - 1
    split = (
        F.when(F.col("transaction_id").isNull(), F.array(outcome(SKIPPED, n)))
        .when(F.col("seen"), F.array(outcome(FAST_PATH_SKIP, n)))
        .when(
            F.col("stored"),
            F.array(outcome(DUPLICATE, F.lit(1)), outcome(FAST_PATH_SKIP, later)),
        )
        .otherwise(F.array(outcome(PROJECTED, F.lit(1)), outcome(FAST_PATH_SKIP, later)))
    )
    return (
        deliveries.join(seen, "transaction_id", "left")
        .join(stored, "transaction_id", "left")
        .select(F.inline(split))
        .groupBy("outcome")
        .agg(F.sum("n").alias("events"))
        .filter(F.col("events") > 0)
    )
