"""Rate limiting: so many calls per caller and window, the rest refused."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetflow.operators.joins import replicated, salted
from packetflow.session import prepare

# Calls per window, and its length.
PERMITS = 100
WINDOW_MS = 10_000

ANONYMOUS = "anonymous"


def with_caller(calls: DataFrame) -> DataFrame:
    """Add ``caller``: token subject, else name, else address, else anonymous."""
    identity = F.coalesce("subject", "user_name", "remote_ip", F.lit(ANONYMOUS))
    return calls.withColumn("caller", identity)


def fixed_window_admission(
    calls: DataFrame,
    permits: int = PERMITS,
    window_ms: int = WINDOW_MS,
    used: DataFrame | None = None,
) -> DataFrame:
    """Every call with ``caller``, ``window_start_ms`` and ``admitted``.

    Windows are aligned to the epoch, calls ordered by time and id. Ranking all calls of a caller
    would put a busy caller into one task. Instead the last call admitted is looked for, where
    each task sends on ``permits`` calls at most, and every call is compared with it. Windows that
    do not fill have none. The comparison is salted: busy callers are the ones it is about.

    ``used`` (``caller, window_start_ms, used``) are permits that earlier calls took.
    """
    if permits < 1:
        raise ValueError("permits must be positive")
    prepare(calls.sparkSession)
    start = F.col("ts_ms") - F.pmod(F.col("ts_ms"), F.lit(window_ms).cast("bigint"))
    keyed = with_caller(calls).withColumn("window_start_ms", start)
    group = ["caller", "window_start_ms"]
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("ts_ms", "call_id"))
    ranked = (
        keyed.select(*group, "ts_ms", "call_id")
        .withColumn("__rank", rank)
        .filter(F.col("__rank") <= permits if used is not None else F.col("__rank") == permits)
    )
    call = F.struct("ts_ms", "call_id")
    if used is None:
        last = ranked.select(*group, call.alias("__last"), F.lit(permits).alias("__left"))
    else:
        left = F.greatest(F.lit(permits) - F.coalesce("used", F.lit(0)), F.lit(0))
        last = (
            ranked.join(used, group, "left").withColumn("__left", left)
            .filter(F.col("__rank") == F.greatest("__left", F.lit(1)))
            .select(*group, call.alias("__last"), "__left")
        )
    joined = salted(keyed, ["call_id"]).join(replicated(last), [*group, "__salt"], "left")
    within = F.col("__last").isNull() | ((F.col("__left") > 0) & (call <= F.col("__last")))
    return joined.withColumn("admitted", within.cast("int")).drop("__salt", "__last", "__left")
