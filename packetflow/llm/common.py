"""What the operators share: tables, chunks of text, words and their hashes, model folders."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from typing import NamedTuple
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import packetflow
from packetflow.session import work_dir

#: Bytes of text that a task turns into words at once; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20

#: Bytes of input (as stored) for which one more shard of a hashed structure is made.
SHARD_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % modulus, F.lit(-1))


def chunks(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``limit`` bytes of ``column``, or of one row; every row is in one slice."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        ends = np.cumsum(sizes.astype(np.int64))
        start, base = 0, 0
        while start < len(ends):
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


class Words(NamedTuple):
    """The words of several texts: ``codes[offsets[i]:offsets[i + 1]]`` are those of text i."""

    codes: np.ndarray
    offsets: np.ndarray
    words: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def split_words(text: pa.Array, lower: bool = True) -> Words:
    """Words between ASCII white space (null: none), A-Z in lower case if asked for."""
    text = pc.fill_null(text, "")
    parts = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
    encoded = parts.values.dictionary_encode()
    codes = encoded.indices.to_numpy(False).astype(np.int64)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    empty = pc.index(encoded.dictionary, "").as_py()
    if empty >= 0:  # what stands before leading and after trailing white space
        keep = codes != empty
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return Words(codes, offsets, encoded.dictionary)


def hash_words(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word."""
    values = words.cast(pa.binary()).to_pylist()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, values), np.uint64, len(values))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def window_hashes(hashes: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash for each window of ``width`` consecutive words."""
    total = np.full(len(starts), width, np.uint64)
    factor = np.uint64(0xA24BAED4963EE407)
    for i in range(width):
        total = total * factor + hashes[starts + i]
    return mixed(total)


def window_starts(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of ``width`` words begin, and the number of the text each is in."""
    windows = np.maximum(words.counts - width + 1, 0)
    texts = np.repeat(np.arange(len(windows)), windows)
    first = np.cumsum(windows) - windows
    return words.offsets[texts] + np.arange(len(texts)) - first[texts], texts


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and at the end the length."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    changes = np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1
    return np.concatenate([[0], changes, [len(sorted_values)]])


def by_shard(shards: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard number and the rows that belong to it, in their order."""
    order = np.argsort(shards, kind="stable")
    bounds = runs(shards[order])
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        if end > begin:
            yield int(shards[order[begin]]), order[begin:end]


def shard_bits(df: DataFrame, bytes_per_shard: int = SHARD_BYTES) -> int:
    """Bits of a hash that number the shards: their number follows the size of the input.

    The size is the one the optimizer knows of files and local rows; where it knows none, the
    text is measured.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= 1 << 60:
        size = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(3, min(24, (max(size, 1) // bytes_per_shard).bit_length()))


def joined(chunked: pa.ChunkedArray | pa.Array, dtype: type) -> np.ndarray:
    """The numbers of a column of packed arrays, one after the other."""
    return np.frombuffer(b"".join(chunked.to_pylist()), dtype)


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow``: whole columns, no row at a time."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def grouped_arrow(
    df: DataFrame, key: str, function: Callable[[pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``applyInArrow`` over groups of bounded size, such as shards."""
    ship(df.sparkSession)

    def run(group: pa.Table) -> pa.Table:
        try:
            return function(group)
        finally:
            give_back()

    return df.groupBy(key).applyInArrow(run, schema)


def give_back() -> None:
    """Return free memory to the system: workers live on, and other stages run in them."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def ship(spark: SparkSession) -> None:
    """Give the tasks this package, wherever the driver has it from; once for each context."""
    context = spark.sparkContext
    if getattr(context, "_packetflow_shipped", False):
        return
    root = Path(packetflow.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="packetflow-")) / "packetflow.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(root.rglob("*.py")):
            file.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._packetflow_shipped = True


def model_folder(spark: SparkSession, name: str) -> str:
    """A new folder for arrays that tasks write and memory-map, below the shared folder.

    The folder has to be mounted on all machines, since a memory map needs a file: with another
    kind of store, name its mount point in ``spark.checkpoint.dir``.
    """
    folder = urlparse(work_dir(spark, name))
    if folder.scheme not in ("", "file"):
        raise RuntimeError(f"{folder.scheme}: is not a mounted folder; arrays cannot be mapped")
    return folder.path
