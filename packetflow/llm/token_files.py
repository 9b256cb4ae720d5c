"""Token ids in files of independent zstandard frames with a seek table.

A file holds the ids of documents in ascending order of their ids. It consists of

* data frames: each an independent zstandard frame with a content checksum, of ``FRAME_IDS`` ids
  (the last one of fewer), little-endian unsigned numbers of two or four bytes;
* an index frame, which decoders skip: a compressed Arrow table of ``doc_id, n_tokens``, with the
  width of an id in its metadata;
* the seek table of the public seekable format, again a frame that decoders skip: compressed size,
  size and checksum (the low 32 bits of XXH64 of the content) of every frame before it, their
  number, and its magic number at the very end.

So any zstandard decoder turns a file into the plain ids, and a reader that wants some documents
reads the end of the file, then the frames that hold them, each checked against its checksum.

Documents are dealt out by range of their ids, so files follow each other in order. A task streams
its rows into one file under a name of its own and returns a row about it; only files with such a
row belong to the table, whatever a task that was lost has left behind.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetflow.llm.common import chunks, map_arrow
from packetflow.llm.packing import Encoder

#: Ids in a data frame.
FRAME_IDS = 1 << 17

#: Bytes of stored text for which one more file is written, and below which none is.
FILE_BYTES, LEAST_FILE_BYTES = 128 << 20, 1 << 20

#: Documents that may be asked for by number at once; for more, read all and join.
MAX_WANTED = 1_000_000

#: Files whose starts are summed in one group.
GROUP_FILES = 1024

#: Fixed values of the public formats: frames to skip, the seek table, its end.
INDEX_MAGIC, TABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FILE_ROW = "part long, file string, documents long, n_ids long"


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and its path there; a plain path is one of this machine."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = folder[5:]
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


class Frame(NamedTuple):
    """A frame of a file: where it begins, and where its ids do."""

    offset: int
    stored: int
    start: int
    size: int
    checksum: int


class TokenWriter:
    """Appends ids to a file and closes it with its index and its seek table."""

    def __init__(self, sink, width: int, frame_ids: int = FRAME_IDS, level: int = 3):
        self.sink, self.width, self.frame_ids = sink, width, frame_ids
        self.dtype = np.dtype("<u2" if width == 2 else "<u4")
        self.packer = zstandard.ZstdCompressor(
            level=level, write_checksum=True, write_content_size=True
        )
        self.waiting: list[np.ndarray] = []
        self.held = self.written = 0
        self.table: list[tuple[int, int, int]] = []

    def append(self, ids: np.ndarray) -> None:
        if len(ids):
            self.waiting.append(ids.astype(self.dtype))
            self.held += len(ids)
            self.written += len(ids)
        if self.held >= self.frame_ids:
            ready = np.concatenate(self.waiting)
            full = len(ready) // self.frame_ids * self.frame_ids
            for at in range(0, full, self.frame_ids):
                self._frame(ready[at : at + self.frame_ids])
            self.waiting, self.held = [ready[full:].copy()], len(ready) - full

    def _frame(self, ids: np.ndarray) -> None:
        content = ids.tobytes()
        stored = self.packer.compress(content)
        self.sink.write(stored)
        checksum = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        self.table.append((len(stored), len(content), checksum))

    def close(self, index: pa.Table) -> None:
        """Write what is left, the index of the documents and the seek table."""
        if self.held:
            self._frame(np.concatenate(self.waiting))
        buffer = io.BytesIO()
        index = index.replace_schema_metadata({"width": str(self.width)})
        with pa.ipc.new_stream(buffer, index.schema) as stream:
            stream.write_table(index)
        content = self.packer.compress(buffer.getvalue())
        self.sink.write(struct.pack("<II", INDEX_MAGIC, len(content)) + content)
        checksum = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        self.table.append((len(content) + 8, 0, checksum))
        entries = b"".join(struct.pack("<III", *entry) for entry in self.table)
        size = len(entries) + 9
        self.sink.write(struct.pack("<II", TABLE_MAGIC, size) + entries)
        self.sink.write(struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC))


class TokenReader:
    """Random access to a file: its index, and the ids of any range."""

    def __init__(self, source):
        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        size = source.size()
        count, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a file of frames with a seek table")
        table_size = 12 * count + 17
        head = struct.unpack("<II", self._read(size - table_size, 8))
        if head != (TABLE_MAGIC, table_size - 8):
            raise ValueError("the seek table is damaged")
        entries = list(struct.iter_unpack("<III", self._read(size - table_size + 8, 12 * count)))
        begin = size - table_size - entries[-1][0]
        stored = self._read(begin + 8, entries[-1][0] - 8)
        _check(stored, entries[-1][2])
        with pa.ipc.open_stream(self.unpacker.decompress(stored)) as stream:
            self.index = stream.read_all()
        self.width = int(self.index.schema.metadata[b"width"])
        self.dtype = np.dtype("<u2" if self.width == 2 else "<u4")
        self.frames, offset, start = [], 0, 0
        for stored_size, content_size, checksum in entries[:-1]:
            ids = content_size // self.width
            self.frames.append(Frame(offset, stored_size, start, ids, checksum))
            offset, start = offset + stored_size, start + ids
        self.starts = np.array([f.start for f in self.frames], np.int64)

    def _read(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def frame(self, number: int) -> np.ndarray:
        """The ids of one frame, checked."""
        frame = self.frames[number]
        content = self.unpacker.decompress(self._read(frame.offset, frame.stored))
        _check(content, frame.checksum)
        return np.frombuffer(content, self.dtype)

    def holding(self, begin: int, end: int) -> range:
        """The numbers of the frames with ids of this range."""
        if begin >= end:
            return range(0)
        first = int(np.searchsorted(self.starts, begin, "right")) - 1
        return range(first, int(np.searchsorted(self.starts, end, "left")))


def _check(content: bytes, checksum: int) -> None:
    if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
        raise ValueError("a frame does not have the checksum of the seek table")


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts with one more id after each text, and where each text begins."""
    count = len(offsets) - 1
    after = offsets + np.arange(count + 1)
    result = np.full(len(ids) + count, end, np.uint32)
    keep = np.ones(len(result), bool)
    keep[after[1:] - 1] = False
    result[keep] = ids
    return result, after


def _write_file(folder: str, tokenizer: str, end: int, width: int, frame_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sink, writer = Encoder.of(tokenizer), None, None
        names, lengths = [], []
        system, path = open_folder(folder)
        part = TaskContext.get().partitionId()
        file = f"part-{part:07d}-{uuid.uuid4().hex}.zst"
        for chunk in chunks(batches):
            if sink is None:
                sink = system.open_output_stream(f"{path}/{file}", compression=None)
                writer = TokenWriter(sink, width, frame_ids)
            ids, offsets = encoder.encode(chunk.column("text"))
            ids, offsets = with_end(ids, offsets, end)
            writer.append(ids)
            names.append(chunk.column("doc_id"))
            lengths.append(np.diff(offsets))
        if sink is None:
            return
        lengths = np.concatenate(lengths).astype(np.int64)
        writer.close(
            pa.table({"doc_id": pa.chunked_array(names), "n_tokens": pa.array(lengths)})
        )
        sink.close()
        row = {"part": [part], "file": [file], "documents": [len(lengths)], "n_ids": [writer.written]}
        yield pa.RecordBatch.from_pydict(
            row, pa.schema([("part", "int64"), ("file", "string"), ("documents", "int64"), ("n_ids", "int64")])
        )

    return write


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end: int, text: str = "text",
    doc_id: str = "doc_id", width: int = 2, frame_ids: int = FRAME_IDS, files: int | None = None,
) -> None:
    """Write the ids of every whole text, each with ``end`` after it, in ascending order of ids.

    A null text is an empty one; a null id comes first; rows of one id are ordered by their text.
    Only the two columns named are read. An empty table gives a folder without files. ``width`` is
    the bytes of an id; two are enough for a vocabulary of 65,536.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if files is None:
        size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        least = min(4 * spark.sparkContext.defaultParallelism, size // LEAST_FILE_BYTES)
        files = max(1, least, min(size // FILE_BYTES, 1_000_000))
    system, path = open_folder(f"{folder}/ids")
    system.create_dir(path, recursive=True)
    # rows of a very frequent id are parted by their texts
    placed = rows.withColumn("tie", F.xxhash64("text"))
    ordered = placed.repartitionByRange(files, "doc_id", "tie").sortWithinPartitions(
        "doc_id", "tie", "text"
    )
    job = _write_file(f"{folder}/ids", tokenizer, end, width, frame_ids)
    map_arrow(ordered.select("doc_id", "text"), job, FILE_ROW).write.mode("overwrite").parquet(
        f"{folder}/files"
    )


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """``part, file, documents, n_ids, start``: the files in order and the ids before each."""
    files = spark.read.schema(FILE_ROW).parquet(f"{folder}/files")
    grouped = files.withColumn("group", F.floor(F.col("part") / GROUP_FILES))
    earlier = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = grouped.groupBy("group").agg(F.sum("n_ids").alias("total")).select(
        "group", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("group_start")
    )
    within = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    placed = grouped.withColumn("own", own).join(starts, "group")
    return placed.select("part", "file", "documents", "n_ids", (F.col("group_start") + F.col("own")).alias("start"))


def _readers(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[tuple[TokenReader, int]]:
    system, path = open_folder(folder)
    for batch in batches:
        for row in batch.to_pylist():
            with system.open_input_file(f"{path}/{row['file']}") as source:
                yield TokenReader(source), row["start"]


def _digests(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for reader, start in _readers(batches, folder):
            lengths = reader.index.column("n_tokens").to_numpy()
            ends = np.cumsum(lengths)
            sums = np.zeros(len(lengths), np.int64)
            current = 0
            for number, frame in enumerate(reader.frames):
                content = memoryview(reader.frame(number).astype("<u4").tobytes())
                begin = 0
                while begin < frame.size:
                    stop = min(frame.size, int(ends[current]) - frame.start)
                    sums[current] = zlib.crc32(content[4 * begin : 4 * stop], int(sums[current]))
                    begin = stop
                    current += frame.start + stop == ends[current]
            arrays = [
                reader.index.column("doc_id").combine_chunks(),
                pa.array(start + ends - lengths), pa.array(lengths), pa.array(sums),
            ]
            yield from pa.table(arrays, ["doc_id", "start", "n_tokens", "ids_crc32"]).to_batches(10_000)

    return read


def _dealt(spark: SparkSession, folder: str) -> DataFrame:
    """The files, about one to a task."""
    files = read_files(spark, folder).select("file", "start")
    return files.repartition(max(1, files.count()), "file")


def read_digests(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, out of the files alone.

    ``start`` counts the ids of all documents before it; the digest is the crc32 of its ids as
    little-endian numbers of four bytes.
    """
    schema = f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long"
    return map_arrow(_dealt(spark, folder), _digests(f"{folder}/ids"), schema)


def _documents(folder: str, wanted: frozenset):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for reader, start in _readers(batches, folder):
            names = reader.index.column("doc_id").to_pylist()
            lengths = reader.index.column("n_tokens").to_numpy()
            ends = np.cumsum(lengths)
            held: dict[int, np.ndarray] = {}
            for row in (i for i, name in enumerate(names) if name in wanted):
                begin, end = int(ends[row] - lengths[row]), int(ends[row])
                numbers = reader.holding(begin, end)
                held = {n: held[n] if n in held else reader.frame(n) for n in numbers}
                ids = np.concatenate([held[n] for n in numbers])
                base = reader.frames[numbers[0]].start
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[row]], reader.index.schema.field("doc_id").type),
                        pa.array([start + begin], pa.int64()),
                        pa.array([ids[begin - base : end - base].astype(np.int32)], pa.list_(pa.int32())),
                    ],
                    ["doc_id", "start", "ids"],
                )

    return read


def read_documents(
    spark: SparkSession, folder: str, wanted: Sequence, id_type: str = "long"
) -> DataFrame:
    """``doc_id, start, ids`` of the documents asked for; only frames that hold them are unpacked.

    An id that several rows have gives each of them; one that no row has gives nothing.
    """
    if len(wanted) > MAX_WANTED:
        raise ValueError(f"more than {MAX_WANTED} documents: read all of them and join")
    schema = f"doc_id {id_type}, start long, ids array<int>"
    job = _documents(f"{folder}/ids", frozenset(wanted))
    return map_arrow(_dealt(spark, folder), job, schema)
