"""Parquet tables written by micro-batches, so that a replayed batch changes nothing.

Batch N owns the folder ``batch_id=N`` and overwrites it as a whole. What earlier batches wrote is
read with ``before=N``, which leaves out what an interrupted run of N itself may have left.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class BatchTable:
    """A table of one folder per batch. ``partition_by`` columns lie below it."""

    path: str
    schema: str
    partition_by: Sequence[str] = ()
    options: dict[str, str] = field(default_factory=dict)

    def create(self, spark: SparkSession) -> None:
        """Make the table readable before its first batch; works on any Hadoop file system."""
        hadoop = spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(self.path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)

    def write(self, df: DataFrame, batch_id: int) -> None:
        rows = df.select(*StructType.fromDDL(self.schema).names)
        writer = rows.write.mode("overwrite").options(**self.options)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        """All batches, with their ``batch_id``."""
        return spark.read.schema(f"{self.schema}, batch_id BIGINT").parquet(self.path)

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What batches before ``batch_id`` wrote; the others are not scanned."""
        return self.read(spark).filter(F.col("batch_id") < batch_id)

    def upto(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return self.read(spark).filter(F.col("batch_id") <= batch_id)

    def only(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return self.batches(spark, [batch_id])

    def remove(self, spark: SparkSession, batch_ids: Sequence[int]) -> None:
        """Delete the folders of batches that nothing reads any more."""
        hadoop = spark._jvm.org.apache.hadoop.fs
        for number in batch_ids:
            folder = hadoop.Path(f"{self.path}/batch_id={number}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    def batches(self, spark: SparkSession, batch_ids: Sequence[int]) -> DataFrame:
        """Given batches by name: the other folders are not even listed."""
        schema = f"{self.schema}, batch_id BIGINT"
        if not batch_ids:
            return spark.createDataFrame([], schema)
        folders = [f"{self.path}/batch_id={number}" for number in batch_ids]
        return spark.read.schema(schema).option("basePath", self.path).parquet(*folders)


@dataclass(frozen=True)
class FoldedTable:
    """Batch deltas that fold into a current state, with a snapshot every so many batches.

    The snapshot of batch S replaces all deltas up to S. Which snapshot a reader needs follows from
    the batch number alone, so it opens one snapshot and fewer than ``every`` deltas, however long
    the stream has run. Batches are numbered from 0 without gaps, as :class:`CommitLog` does. Deltas
    and snapshots are deleted once a later snapshot but one holds them.
    """

    deltas: BatchTable
    snapshots: BatchTable
    fold: Callable[[DataFrame], DataFrame]
    every: int = 50

    @classmethod
    def at(
        cls, path: str, schema: str, fold: Callable[[DataFrame], DataFrame], every: int = 50
    ) -> FoldedTable:
        return cls(
            BatchTable(f"{path}/deltas", schema),
            BatchTable(f"{path}/snapshots", schema),
            fold,
            every,
        )

    def create(self, spark: SparkSession) -> None:
        self.deltas.create(spark)
        self.snapshots.create(spark)

    def write(self, delta: DataFrame, batch_id: int, keep: Column | None = None) -> None:
        """Write the delta of a batch and, when it is due, the snapshot that includes it.

        Rows of a snapshot that ``keep`` is not true for are no longer needed by any later batch.
        """
        self.deltas.write(delta, batch_id)
        if batch_id > 0 and batch_id % self.every == 0:
            state = self.fold(self._rows_after(delta.sparkSession, batch_id - self.every, batch_id))
            self.snapshots.write(state if keep is None else state.filter(keep), batch_id)
            old = batch_id - self.every
            if old > 0:  # those who still read the snapshot before need no delta up to it
                self.deltas.remove(delta.sparkSession, deltas_after(old - self.every, old))
                self.snapshots.remove(delta.sparkSession, [old - self.every])

    def rows(self, spark: SparkSession, upto: int) -> DataFrame:
        """What the state after batch ``upto`` folds from; enough where only keys matter."""
        return self._rows_after(spark, last_multiple(upto, self.every), upto)

    def current(self, spark: SparkSession, upto: int) -> DataFrame:
        """The state after batch ``upto``."""
        return self.fold(self.rows(spark, upto))

    def _rows_after(self, spark: SparkSession, snapshot: int, upto: int) -> DataFrame:
        base = self.snapshots.batches(spark, [snapshot] if snapshot > 0 else [])
        deltas = self.deltas.batches(spark, deltas_after(snapshot, upto))
        return base.unionByName(deltas).drop("batch_id")


def last_multiple(batch_id: int, every: int) -> int:
    """The last batch up to this one at which tables were merged; 0 stands for none."""
    return max(batch_id, 0) // every * every


def deltas_after(merged: int, upto: int) -> list[int]:
    """Batches not merged yet; batch 0 waits for the first merge."""
    return list(range(merged + 1 if merged > 0 else 0, upto + 1))


@dataclass(frozen=True)
class BucketedTable:
    """A growing table with a unique key: deltas, and every so many batches one bucketed table of all.

    The table of batch S holds every row up to S, bucketed and sorted by the key. It is written by a
    plain job, an ordinary Spark table that names its folder, so what is joined with it by the key
    meets it bucket by bucket and is the only side that is shuffled, and keys asked for by name open
    their buckets only. Which table a reader needs follows from the batch number alone. ``every`` is
    how often the rows are written anew: set it to a day of batches where the table is large.
    """

    deltas: BatchTable
    key: str
    buckets: int = 64
    every: int = 50

    @classmethod
    def at(
        cls, path: str, schema: str, key: str, every: int = 50, buckets: int = 64,
        options: dict[str, str] | None = None,
    ) -> BucketedTable:
        return cls(BatchTable(f"{path}/deltas", schema, options=options or {}), key, buckets, every)

    def create(self, spark: SparkSession) -> None:
        self.deltas.create(spark)

    def _place(self, batch_id: int) -> tuple[str, str]:
        """The name in the catalog and the folder of the table that ends with a batch."""
        folder = f"{self.deltas.path.removesuffix('/deltas')}/upto/{batch_id}"
        return f"packetflow_{hashlib.md5(folder.encode()).hexdigest()}", folder

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Write the rows of a batch and, when it is due, the table that ends with it."""
        self.deltas.write(rows, batch_id)
        self.merge(rows.sparkSession, batch_id)

    def merge(self, spark: SparkSession, batch_id: int) -> None:
        """Write the table that ends with a batch whose rows are written, when it is due."""
        if batch_id > 0 and batch_id % self.every == 0:
            self._rebuild(spark, batch_id)

    def _rebuild(self, spark: SparkSession, batch_id: int) -> None:
        before = batch_id - self.every
        deltas = self.deltas.batches(spark, deltas_after(before, batch_id)).drop("batch_id")
        rows = deltas if before <= 0 else self._stored(spark, before).unionByName(deltas)
        name, folder = self._place(batch_id)
        writer = rows.repartition(self.buckets, self.key).write.mode("overwrite")
        writer = writer.options(**self.deltas.options).option("path", folder)
        writer.bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(name)

    def _stored(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The bucketed table; a session that does not know it yet learns of its folder."""
        name, folder = self._place(batch_id)
        if not spark.catalog.tableExists(name):
            spark.sql(
                f"CREATE TABLE {name} ({self.deltas.schema}) USING parquet "
                f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS "
                f"LOCATION '{folder}'"
            )
        spark.catalog.refreshTable(name)
        return spark.table(name)

    def parts(self, spark: SparkSession, upto: int) -> list[DataFrame]:
        """All rows of the batches up to this one: the bucketed table, and what came after it."""
        merged = last_multiple(upto, self.every)
        deltas = self.deltas.batches(spark, deltas_after(merged, upto)).drop("batch_id")
        return [self._stored(spark, merged), deltas] if merged > 0 else [deltas]

    def upto(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return reduce(DataFrame.unionByName, self.parts(spark, batch_id))

    def only(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return self.deltas.only(spark, batch_id).drop("batch_id")


#: Commits kept; only the last one is ever asked for.
COMMITS_KEPT = 100


@dataclass(frozen=True)
class CommitState:
    """The last finished batch of a root (-1: none) and the last batch of each stream."""

    last: int
    written: dict[str, int]

    def next_number(self, writer: str, stream_batch: int) -> int | None:
        """The number a batch of a stream gets, None if it is finished already."""
        return None if stream_batch <= self.written.get(writer, -1) else self.last + 1

    def others(self, writer: str) -> bool:
        """Whether another stream has written here, so that a row may come for a second time."""
        return any(name != writer for name in self.written)


@dataclass(frozen=True)
class CommitLog:
    """The finished batches of the tables of one root, and the streams that wrote them.

    Batches are numbered on by the tables, whichever stream writes: the number after the last commit.
    A commit holds the last batch of every stream that ever wrote, by the id in its checkpoint, so
    a batch that a stream delivers again is known as finished, also after others have written. One
    stream at a time writes.
    """

    table: BatchTable

    @classmethod
    def at(cls, path: str) -> CommitLog:
        return cls(BatchTable(path, "writer STRING, stream_batch BIGINT, rows BIGINT"))

    def create(self, spark: SparkSession) -> None:
        self.table.create(spark)

    def state(self, spark: SparkSession) -> CommitState:
        rows = self.table.read(spark).collect()
        last = max((r["batch_id"] for r in rows), default=-1)
        return CommitState(
            last, {r["writer"]: r["stream_batch"] for r in rows if r["batch_id"] == last}
        )

    def last(self, spark: SparkSession) -> int:
        """The last finished batch, -1 if there is none."""
        return self.state(spark).last

    def write(
        self, spark: SparkSession, state: CommitState, writer: str, stream_batch: int, rows: int
    ) -> None:
        """Finish the batch that comes next after ``state``."""
        written = state.written | {writer: stream_batch}
        kinds = [f.dataType for f in StructType.fromDDL(self.table.schema).fields]
        held = F.array(
            *[
                F.struct(*[F.lit(v).cast(k) for v, k in zip(row, kinds, strict=True)])
                for row in ((w, b, rows if w == writer else None) for w, b in sorted(written.items()))
            ]
        )
        names = StructType.fromDDL(self.table.schema).names
        one = spark.range(0, 1, 1, 1).select(F.inline(held)).toDF(*names)
        self.table.write(one, state.last + 1)
        self.table.remove(spark, [state.last + 1 - COMMITS_KEPT])


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of a checkpoint, kept in it: a new folder is a new stream, whatever its name."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{checkpoint}/writer-id")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        row = spark.range(0, 1, 1, 1).select(F.lit(uuid.uuid4().hex).alias("id"))
        row.write.mode("overwrite").parquet(folder.toString())
    return spark.read.schema("id STRING").parquet(folder.toString()).first()["id"]
