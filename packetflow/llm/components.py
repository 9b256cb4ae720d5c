"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetflow.session import shared_dir


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its smallest node.

    Rounds of two steps, each a partial aggregate and a join: every node hangs its larger
    neighbours, then its smaller ones, under the smallest node it knows, until nothing changes.
    A star with very many leaves is only a skewed join key, which adaptive execution splits; the
    number of rounds grows with the logarithm of the longest chain. Every round is checkpointed
    in the shared folder.
    """
    shared_dir(edges.sparkSession)
    current = (
        edges.select(
            F.greatest(left, right).alias("a"), F.least(left, right).alias("b")
        )
        .filter("a > b")
        .distinct()
        .checkpoint()
    )
    seen = _fingerprint(current)
    while seen[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m"))
        smallest = smallest.select("a", F.least("a", "m").alias("m"))
        large = (
            both.filter("b > a").join(smallest, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        current = (
            small.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lowest.select("a", F.col("m").alias("b")))
            .filter("a > b")
            .distinct()
            .checkpoint()
        )
        before, seen = seen, _fingerprint(current)
        if before == seen:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots
    )


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and a sum that changes with them; one row comes to the driver."""
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")
    ).first()
    return row["n"], int(row["s"] or 0)
