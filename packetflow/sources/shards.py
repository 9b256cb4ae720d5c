"""The sharded document store: one Parquet folder per batch and protocol class."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow import schemas
from packetflow.operators.routing import change_feed
from packetflow.sources.batches import BatchTable, CommitLog

ROWS_PER_FILE = 5_000_000


def shard_table(path: str) -> BatchTable:
    """Documents by batch and shard.

    Each task writes the shards it has rows of, so no shard passes through one task; the row limit
    keeps the files of a large one apart.
    """
    limit = {"maxRecordsPerFile": str(ROWS_PER_FILE)}
    return BatchTable(path, schemas.SHARD_DOCUMENT, partition_by=("shard",), options=limit)


def read_shards(spark: SparkSession, path: str, shards: Sequence[str] | None = None) -> DataFrame:
    """Stored documents; with ``shards`` given, only their folders are read."""
    documents = shard_table(path).read(spark)
    return documents if shards is None else documents.filter(F.col("shard").isin(*shards))


def shard_change_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """The change events of the store as a stream: new files hold new documents."""
    reader = spark.readStream.schema(f"{schemas.SHARD_DOCUMENT}, batch_id BIGINT")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return change_feed(reader.parquet(path))


@dataclass(frozen=True)
class MergedShards:
    """The store with the small files of many batches rewritten, shard by shard.

    ``path`` is where the router writes. A merge is a plain job, run every hour or day: it writes the
    documents of the batches since the last merge below ``shard=<name>`` folders, in files of about
    ``rows_per_file``, and then takes the folders of the merge before away. The change feed goes on
    reading the batches as they come and never the merged files, so no document comes twice; it has
    the time between two merges to read a batch.
    """

    path: str
    rows_per_file: int = ROWS_PER_FILE

    @property
    def batches(self) -> BatchTable:
        return shard_table(self.path)

    @property
    def merges(self) -> CommitLog:
        """Finished merges; ``rows`` is the last batch each holds."""
        return CommitLog.at(f"{self.path.rstrip('/')}-merges")

    @property
    def merged(self) -> str:
        return f"{self.path.rstrip('/')}-merged"

    def _last(self, spark: SparkSession) -> tuple[int, int]:
        """The number of the last merge and of the last batch in it, -1 for none."""
        self.merges.create(spark)
        last = self.merges.last(spark)
        if last < 0:
            return -1, -1
        return last, self.merges.table.only(spark, last).first()["rows"]

    def merge(self, spark: SparkSession, upto: int) -> None:
        """Merge the finished batches up to this one, such as the last commit of the router."""
        number, before = self._last(spark)
        if upto <= before:
            return
        new = self.batches.batches(spark, list(range(before + 1, upto + 1)))
        documents = new.drop("batch_id").withColumn("merge_id", F.lit(number + 1))
        sizes = documents.groupBy("shard").count().collect()  # a row for each protocol class
        files = F.lit(1)
        for row in sizes:
            own = F.lit(-(-row["count"] // self.rows_per_file))
            files = F.when(F.col("shard") == row["shard"], own).otherwise(files)
        # a large shard is dealt out over as many tasks as it gets files
        piece = F.pmod(F.xxhash64("packet_id"), files)
        (
            documents.repartition("shard", piece).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", self.rows_per_file)
            .partitionBy("shard", "merge_id").parquet(self.merged)
        )
        state = self.merges.state(spark)
        self.merges.write(spark, state, "", number + 1, upto)
        if number >= 0:  # readers may still be at the merge before, which holds those up to it
            first = -1
            if number > 0:
                first = self.merges.table.only(spark, number - 1).first()["rows"]
            self.batches.remove(spark, list(range(first + 1, before + 1)))

    def read(self, spark: SparkSession, upto: int, shards: Sequence[str] | None = None) -> DataFrame:
        """All documents of the batches up to this one; of given shards only their folders."""
        number, merged = self._last(spark)
        schema = f"{schemas.SHARD_DOCUMENT}, merge_id BIGINT"
        new = self.batches.batches(spark, list(range(merged + 1, upto + 1))).drop("batch_id")
        if number >= 0:
            held = spark.read.schema(schema).parquet(self.merged)
            new = held.filter(F.col("merge_id") <= number).drop("merge_id").unionByName(new)
        return new if shards is None else new.filter(F.col("shard").isin(*shards))
