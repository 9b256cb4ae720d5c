"""Choosing and numbering rows within groups, also where one group holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark cuts every partition down to one row per key before the shuffle (WindowGroupLimit), so
    a key with many rows sends one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(window))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def _range_of(value: Column, bounds: Sequence[Column], first: int = 0) -> Column:
    """The number of bounds below a value, found by halving: few comparisons for many bounds."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    above = _range_of(value, bounds[middle + 1 :], first + middle + 1)
    return F.when(value > bounds[middle], above).otherwise(
        _range_of(value, bounds[:middle], first)
    )


#: Ranges that are told apart by one look; a large table is looked at twice.
RANGES = 256


def with_range(df: DataFrame, order: str, rows_in_range: int, name: str) -> DataFrame:
    """Add ``name``, the number of a range of ``order`` that holds about so many rows.

    The values are cut at their approximate quantiles, so outliers and gaps change nothing. Up to
    ``RANGES`` ranges are cut at once; more are cut out of these, up to the square of that number.
    The bounds of the first come to the driver, those of the others are a broadcast of ``RANGES``
    rows.
    """
    rows = df.agg(F.count(order)).first()[0]
    wanted = -(-rows // rows_in_range)
    if wanted <= 1:
        return df.withColumn(name, F.lit(0))

    def quantiles(ranges: int) -> Column:
        shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
        return F.percentile_approx(order, shares, 10 * ranges)

    first = min(RANGES, wanted)
    bounds = df.agg(quantiles(first)).first()[0]
    value = F.col(order)
    cut = df.withColumn(name, _range_of(value, [F.lit(b) for b in bounds]))
    if wanted <= RANGES:
        return cut
    second = min(RANGES, -(-wanted // RANGES))
    finer = F.broadcast(cut.groupBy(name).agg(quantiles(second).alias("__bounds")))
    inner = _range_of(value, [F.col("__bounds")[i] for i in range(second - 1)])
    return cut.join(finer, name).withColumn(name, F.col(name) * RANGES + inner).drop("__bounds")


def number_within(
    df: DataFrame, group: Sequence[str], order: str, name: str, bucket_rows: int = 1 << 20
) -> DataFrame:
    """Add ``name``: 1, 2, 3, ... within each group, by ``order``; null is a group like any other.

    ``order`` is an integer sequence number, unique within the group, with or without gaps. The rows
    are cut into ranges of about ``bucket_rows`` rows, see :func:`with_range`, so a task sorts about
    one range however the numbers are spread. The count of each group and range is a partial
    aggregate; a running sum over the counts gives where its numbers start.
    """
    group = list(group)
    bucketed = with_range(df, order, bucket_rows, "__bucket")
    earlier = (
        Window.partitionBy(*group)
        .orderBy("__bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        bucketed.groupBy(*group, "__bucket")
        .agg(F.count("*").alias("__rows"))
        .withColumn("__start", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
        .drop("__rows")
    )
    within = Window.partitionBy(*group, "__bucket").orderBy(order)
    keys = [*group, "__bucket"]
    starts = starts.withColumnsRenamed({key: f"__{key}_of" for key in keys})
    same = reduce(
        lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"__{key}_of")) for key in keys]
    )
    return (
        bucketed.join(starts, same)
        .withColumn(name, F.row_number().over(within) + F.col("__start"))
        .drop("__bucket", "__start", *[f"__{key}_of" for key in keys])
    )
