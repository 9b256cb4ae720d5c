"""Joins against a set that is usually, but not provably, small."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetflow.session import prepare

#: Above this many keys a set is not broadcast (100,000 hashes of 64 characters are about 10 MB).
MAX_BROADCAST_KEYS = 100_000

#: Up to this many keys are named in the filter of the scan that looks for them.
MAX_PUSHED_KEYS = 1_000

#: Pieces a key of the large side is cut into where one key may hold much of the data.
SALTS = 32


def salted(df: DataFrame, spread_by: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Number the rows of a large side so that the rows of one key go to ``salts`` tasks."""
    number = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    return df.withColumn("__salt", number)


def replicated(df: DataFrame, salts: int = SALTS) -> DataFrame:
    """Give each row of a small side to all pieces of its key."""
    return df.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


#: A key with more than one in so many rows is heavy; there are fewer heavy keys than this.
HEAVY_SHARE = 1_000


def heavy_keys(df: DataFrame, on: str) -> list:
    """The keys that hold more than one in ``HEAVY_SHARE`` rows; fewer than that many can."""
    counts = df.groupBy(on).agg(F.count("*").alias("__rows"))
    total = counts.agg(F.sum("__rows")).first()[0] or 0
    found = counts.filter(F.col("__rows") * HEAVY_SHARE > total).limit(HEAVY_SHARE)
    return [row[0] for row in found.collect() if row[0] is not None]


def in_key_set(
    df: DataFrame,
    keys: DataFrame,
    on: str,
    spread_by: Sequence[str],
    keep_members: bool = True,
    size: int | None = None,
    max_broadcast: int = MAX_BROADCAST_KEYS,
    unique: bool = False,
) -> DataFrame:
    """Rows whose ``on`` is (or is not) in ``keys``, whatever the size of the set.

    A set whose ``size`` is not known is counted, up to the bound only. Within it, it is broadcast;
    beyond it, both sides are dealt out by key, and the heavy keys of ``df`` are salted, so that one
    key shared by a third of the rows does not end in one task. Keys that are ``unique`` in ``df``,
    or nearly so, are not looked through for heavy ones.
    """
    how = "left_semi" if keep_members else "left_anti"
    keys = keys.select(on).distinct()
    if size is None:
        size = keys.limit(max_broadcast + 1).count()
    if size <= max_broadcast:
        return df.join(F.broadcast(keys), on, how)
    return df.join(keys, on, how) if unique else join_heavy(df, keys, on, spread_by, how)


def join_heavy(
    df: DataFrame, side: DataFrame, on: str, spread_by: Sequence[str], how: str = "inner"
) -> DataFrame:
    """A join with a side that has each key once; only the heavy keys of ``df`` are salted."""
    heavy = heavy_keys(df.select(on), on)
    if not heavy:
        return df.join(side, on, how)
    is_heavy = F.col(on).isin(heavy)
    number = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int")
    rows = df.withColumn("__salt", F.when(is_heavy, number).otherwise(0))
    last = F.when(is_heavy, F.lit(SALTS - 1)).otherwise(0)
    copies = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), last)))
    return rows.join(copies, [on, "__salt"], how).drop("__salt")


def literal_keys(df: DataFrame, values: Sequence[str], name: str) -> DataFrame:
    """A one-column frame of given values, built inside the JVM."""
    spark = df.sparkSession
    array = F.array(*[F.lit(v) for v in values])
    return spark.range(1).select(F.explode(array).alias(name))


def without_stored(
    batch: DataFrame,
    stored: DataFrame,
    key: str | Sequence[str],
    batch_rows: int | None = None,
    max_broadcast: int = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """Rows of ``batch`` whose ``key``, one column or several, is not stored yet.

    With a known small ``batch_rows`` the stored side is first cut down to the keys of the batch by
    a broadcast, so the large table is scanned for its key and never shuffled; very few keys of one
    column are pushed to the scan, where buckets, statistics and bloom filters skip what can not
    hold them. Otherwise both sides are joined by the key, which is unique on the stored one; a
    table that is bucketed by it is not shuffled then either. Null is a key like any other where
    there are several columns.
    """
    keys = [key] if isinstance(key, str) else list(key)
    stored_keys = stored.select(*keys)
    small = batch_rows is not None and batch_rows <= max_broadcast
    if len(keys) == 1 and small and batch_rows <= MAX_PUSHED_KEYS:
        prepare(batch.sparkSession)
        wanted = [row[0] for row in batch.select(*keys).limit(MAX_PUSHED_KEYS + 1).collect()]
        if len(wanted) <= MAX_PUSHED_KEYS:
            stored_keys = stored_keys.filter(F.col(keys[0]).isin(wanted))
    if len(keys) == 1:
        if small:
            stored_keys = stored_keys.join(F.broadcast(batch.select(*keys)), keys, "left_semi")
        return batch.join(stored_keys, keys, "left_anti")
    named = stored_keys.toDF(*[f"__{k}" for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    if small:
        named = named.join(F.broadcast(batch.select(*keys)), same, "left_semi")
    return batch.join(named, same, "left_anti")
