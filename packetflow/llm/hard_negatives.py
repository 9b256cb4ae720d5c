"""Hard negatives: blocks of vectors along a Hilbert curve, chosen by the bounds of their zone maps.

1. *Index.* Vectors become integers. Each is placed on a Hilbert curve through the main directions
   of the vectors, the rows are dealt out by range of their place and written as Parquet, a row group
   being a block of ``BLOCK_ROWS``. A block leaves one row in the zone map: the least and the greatest
   value of every dimension, of the label, and its least id.
2. *Positives.* A task has a slice of anchors that lie near each other. Interval arithmetic over the
   zone map gives the greatest score a block can have with an anchor; a block is read if that
   reaches what the anchor's last positive has so far, and left out otherwise.
3. *Negatives.* Each anchor and positive make a window of scores. A block is read for the windows
   that its interval of scores meets above their last negative so far.

Both searches are exact; where the curve starts and how wide its cells are only matters for the
number of blocks that are read. A task holds a slice of anchors, one part of the zone map and few
blocks; a label or a vector that very many rows share is spread over blocks like any other.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetflow.llm.common import map_arrow
from packetflow.llm.token_files import open_folder
from packetflow.operators.ranking import best_per_key
from packetflow.session import work_dir

#: Rows of a block, and of a file of blocks.
BLOCK_ROWS, FILE_ROWS = 512, 1 << 18

#: Zones and anchors that a task compares at once.
SLICE_ZONES, SLICE_ANCHORS = 4096, 512

#: Blocks and open files a task keeps.
KEPT_BLOCKS, KEPT_FILES = 256, 32

#: Directions of the curve, bits of each, and vectors that the directions are fitted on.
CURVE_DIMS, CURVE_BITS, SAMPLE_ROWS = 8, 7, 10_000

#: Candidates that are collected before the best of them are chosen.
PENDING = 1 << 15

ZONE = """file string, block int, least_id long, label_low long, label_high long,
    low binary, high binary"""
RESULT = """anchor_id long, positive_id long, rank int, negative_id long,
    positive_score long, negative_score long"""


class Shape(NamedTuple):
    """What all tasks have to know of the vectors; fixes how scores are computed exactly."""

    dims: int
    largest: int

    @property
    def exact(self) -> type:
        """A type whose matrix products are exact for these vectors."""
        most = self.dims * self.largest**2
        return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def usable(
    rows: DataFrame, vec_id: str, vector: str, label: Column, scale: int = 256
) -> DataFrame:
    """``id, label, vector`` with integer components ``floor(scale * x)``.

    Rows without id, label or vector, or with a component that is null or not finite, are left out.
    """
    number = F.col(vector)
    finite = F.forall(
        number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    kept = rows.select(
        F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"),
        F.when(finite, F.transform(number, lambda x: F.floor(x.cast("double") * scale)))
        .alias("vector"),
    )
    return kept.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of cells (``bits`` bits a column) on the Hilbert curve.

    Turns and reflections are undone from the highest bit down, what is left is Gray code.
    """
    x = [column.astype(np.int64) for column in cells.T]
    level = 1 << (bits - 1)
    while level > 1:
        mask = level - 1
        for i in range(len(x)):
            turned = (x[i] & level) != 0
            swap = (x[0] ^ x[i]) & mask
            x[0] = np.where(turned, x[0] ^ mask, x[0] ^ swap)
            if i:
                x[i] = np.where(turned, x[i], x[i] ^ swap)
        level >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros(len(cells), np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        flip = np.where(x[-1] & level, flip ^ (level - 1), flip)
        level >>= 1
    key = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, -1, -1):
        for column in x:
            key = (key << 1) | (((column ^ flip) >> bit) & 1)
    return key


class Curve(NamedTuple):
    """Directions and cell borders, fitted on a bounded sample."""

    directions: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, dims: int = CURVE_DIMS) -> Curve:
        centred = sample - sample.mean(axis=0)
        _, vectors = np.linalg.eigh(centred.T @ centred)
        directions = vectors[:, ::-1][:, : min(dims, sample.shape[1])]
        along = sample @ directions
        return cls(directions, along.min(axis=0), along.max(axis=0))

    def place(self, vectors: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
        width = np.where(self.high > self.low, self.high - self.low, 1.0)
        cells = (vectors @ self.directions - self.low) / width * (1 << bits)
        return hilbert_keys(np.clip(cells, 0, (1 << bits) - 1).astype(np.int64), bits)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of numbers as rows; shorter ones are filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(False)
    if len(column) and (sizes == dims).all():
        return values.reshape(-1, dims).astype(np.int64)
    result = np.zeros((len(column), dims), np.int64)
    rows = np.repeat(np.arange(len(column)), sizes)
    result[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return result


def _placed(curve: Curve, dims: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = curve.place(matrix(batch.column("vector"), dims).astype(float))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "label", "vector")), pa.array(keys)],
                ["id", "label", "vector", "place"],
            )

    return place


def _write_blocks(folder: str, shape: Shape, block_rows: int):
    kind = pa.int32() if shape.largest < 1 << 31 else pa.int64()
    schema = pa.schema(
        [("id", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(kind, shape.dims))]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(f"{folder}/blocks")
        file, writer, zones, waiting = f"{uuid.uuid4().hex}.parquet", None, [], []

        def block(rows: pa.Table) -> None:
            vectors = matrix(rows.column("vector").combine_chunks(), shape.dims)
            flat = pa.array(vectors.reshape(-1)).cast(kind)
            values = pa.FixedSizeListArray.from_arrays(flat, shape.dims)
            columns = [rows.column("id").combine_chunks(), rows.column("label").combine_chunks()]
            writer.write_table(pa.table([*columns, values], schema), row_group_size=len(rows))
            ids, labels = (c.to_numpy() for c in columns)
            ends = (vectors.min(axis=0).tobytes(), vectors.max(axis=0).tobytes())
            zones.append((file, len(zones), ids.min(), labels.min(), labels.max(), *ends))

        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                writer = pq.ParquetWriter(f"{path}/{file}", schema, filesystem=system)
            waiting.append(batch)
            held = pa.Table.from_batches(waiting)
            full = len(held) // block_rows * block_rows
            for at in range(0, full, block_rows):
                block(held.slice(at, block_rows))
            waiting = held.slice(full).to_batches()
        if writer is None:
            return
        if waiting and len(rest := pa.Table.from_batches(waiting)):
            block(rest)
        writer.close()
        kinds = ("string", "int32", "int64", "int64", "int64", "binary", "binary")
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.type_for_alias(k)) for c, k in zip(zip(*zones), kinds)],
            ["file", "block", "least_id", "label_low", "label_high", "low", "high"],
        )

    return write


class Zones(NamedTuple):
    """A part of the zone map."""

    files: list[str]
    blocks: list[int]
    least_id: np.ndarray
    label_low: np.ndarray
    label_high: np.ndarray
    low: np.ndarray
    high: np.ndarray


class Blocks:
    """The index as a task sees it: the zone map part by part, and blocks by their number."""

    def __init__(self, folder: str, shape: Shape):
        self.shape, self.read_blocks = shape, 0
        self.system, self.path = open_folder(folder)
        self.files: OrderedDict[str, pq.ParquetFile] = OrderedDict()
        self.kept: OrderedDict[tuple[str, int], tuple] = OrderedDict()

    def zones(self) -> Iterator[Zones]:
        import pyarrow.dataset as ds

        found = ds.dataset(
            f"{self.path}/zones", filesystem=self.system, format="parquet",
            exclude_invalid_files=False,
        )
        waiting: list[pa.RecordBatch] = []
        for batch in found.to_batches(batch_size=SLICE_ZONES):
            waiting.append(batch)
            if sum(map(len, waiting)) >= SLICE_ZONES:
                yield self._zones(waiting)
                waiting = []
        if sum(map(len, waiting)):
            yield self._zones(waiting)

    def _zones(self, batches: list[pa.RecordBatch]) -> Zones:
        rows = pa.Table.from_batches(batches)

        def ends(name: str) -> np.ndarray:
            joined = b"".join(rows.column(name).to_pylist())
            return np.frombuffer(joined, np.int64).reshape(-1, self.shape.dims)

        numbers = [rows.column(c).to_numpy() for c in ("least_id", "label_low", "label_high")]
        return Zones(
            rows.column("file").to_pylist(), rows.column("block").to_pylist(), *numbers,
            ends("low").astype(self.shape.exact), ends("high").astype(self.shape.exact),
        )

    def read(self, file: str, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, labels and vectors of one block."""
        key = (file, block)
        if key in self.kept:
            self.kept.move_to_end(key)
            return self.kept[key]
        if file not in self.files:
            if len(self.files) >= KEPT_FILES:
                self.files.popitem(last=False)[1].close()
            source = self.system.open_input_file(f"{self.path}/blocks/{file}")
            self.files[file] = pq.ParquetFile(source)
        self.files.move_to_end(file)
        rows = self.files[file].read_row_group(block)
        values = rows.column("vector").combine_chunks().flatten().to_numpy(False)
        vectors = values.reshape(-1, self.shape.dims).astype(self.shape.exact)
        self.read_blocks += 1
        if len(self.kept) >= KEPT_BLOCKS:
            self.kept.popitem(last=False)
        self.kept[key] = rows.column("id").to_numpy(), rows.column("label").to_numpy(), vectors
        return self.kept[key]


class Best:
    """The first ``k`` candidates of each row: higher scores first, then smaller ids."""

    def __init__(self, rows: int, k: int):
        self.k, self.size = k, 0
        self.pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = self.scores = self.ids = np.zeros(0, np.int64)
        self.floor = np.full(rows, -np.inf)  # the last score of a row that has k
        self.last = np.full(rows, np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(rows):
            self.pending.append((rows, scores.astype(np.int64), ids))
            self.size += len(rows)
            if self.size >= PENDING:
                self.settle()

    def settle(self) -> None:
        if not self.pending:
            return
        held = [(self.rows, self.scores, self.ids), *self.pending]
        rows, scores, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        self.pending, self.size = [], 0
        order = np.lexsort((ids, -scores, rows))
        rows = rows[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows, "left")
        keep = place < self.k
        self.rows, self.scores, self.ids = rows[keep], scores[order][keep], ids[order][keep]
        full = place[keep] == self.k - 1
        self.floor[self.rows[full]] = self.scores[full]
        self.last[self.rows[full]] = self.ids[full]

    def open_to(self, upper: np.ndarray, least_id: np.ndarray) -> np.ndarray:
        """Whether a candidate of at most this score and at least this id could still come in."""
        floor, last = self.floor, self.last
        if upper.ndim == 2:
            floor, last = floor[:, None], last[:, None]
        return (upper > floor) | ((upper == floor) & (least_id < last))


class Slice(NamedTuple):
    """Anchors that are searched for together."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    def bounds(self, zones: Zones) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest score of each anchor with any vector of each zone."""
        above, below = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)
        lower = above @ zones.low.T + below @ zones.high.T
        return lower, above @ zones.high.T + below @ zones.low.T


def positives(anchors: Slice, blocks: Blocks, k: int) -> Best:
    """The first ``k`` other rows of each anchor's label."""
    best = Best(len(anchors.ids), k)

    def score(rows: np.ndarray, file: str, block: int) -> None:
        ids, labels, vectors = blocks.read(file, block)
        scores = anchors.vectors[rows] @ vectors.T
        hit = (scores >= best.floor[rows, None]) & (labels == anchors.labels[rows, None])
        r, c = np.nonzero(hit & (ids != anchors.ids[rows, None]))
        best.add(rows[r], scores[r, c], ids[c])

    for zones in blocks.zones():
        upper = anchors.bounds(zones)[1]
        own = (zones.label_low <= anchors.labels[:, None]) & (
            anchors.labels[:, None] <= zones.label_high
        )
        highest = np.where(own, upper, -np.inf).max(axis=0)
        for b in np.argsort(-highest, kind="stable"):
            wanted = own[:, b] & best.open_to(upper[:, b], zones.least_id[b])
            if wanted.any():
                score(np.flatnonzero(wanted), zones.files[b], zones.blocks[b])
                best.settle()
    return best


def negatives(
    anchors: Slice, blocks: Blocks, found: Best, k: int, least: int, most: int
) -> tuple[Best, np.ndarray]:
    """The first ``k`` rows of other labels in the window of each positive, and which are empty.

    A window holds the scores n with ``least * p <= 100 * n <= most * p``.
    """
    owner, p = found.rows, found.scores
    top, bottom = (most * p) // 100, -((-least * p) // 100)
    best = Best(len(owner), k)
    possible = bottom <= top
    for zones in blocks.zones():
        lower, upper = anchors.bounds(zones)
        mixed = (zones.label_low != zones.label_high) | (
            zones.label_low != anchors.labels[:, None]
        )
        meets = possible[:, None] & mixed[owner] & (lower[owner] <= top[:, None])
        meets &= upper[owner] >= bottom[:, None]
        # first the blocks whose greatest score is nearest the top of the most windows
        gap = np.where(meets, np.abs(upper[owner] - top[:, None]), 0).sum(axis=0)
        for b in np.argsort(gap / np.maximum(meets.sum(axis=0), 1), kind="stable"):
            reach = np.minimum(upper[owner, b], top)
            rows = np.flatnonzero(meets[:, b] & best.open_to(reach, zones.least_id[b]))
            if not len(rows):
                continue
            ids, labels, vectors = blocks.read(zones.files[b], zones.blocks[b])
            some, at = np.unique(owner[rows], return_inverse=True)
            scores = (anchors.vectors[some] @ vectors.T)[at]
            low = np.maximum(bottom[rows], best.floor[rows])[:, None]
            hit = (scores >= low) & (scores <= top[rows, None])
            hit &= labels != anchors.labels[owner[rows], None]
            r, c = np.nonzero(hit & (ids != anchors.ids[owner[rows], None]))
            best.add(rows[r], scores[r, c], ids[c])
            best.settle()
    best.settle()
    return best, possible


def _search(folder: str, shape: Shape, k: tuple[int, int], window: tuple[int, int]):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(folder, shape)
        for batch in batches:
            for at in range(0, len(batch), SLICE_ANCHORS):
                part = batch.slice(at, SLICE_ANCHORS)
                vectors = matrix(part.column("vector"), shape.dims).astype(shape.exact)
                ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
                anchors = Slice(ids, labels, vectors)
                found = positives(anchors, blocks, k[0])
                best, _ = negatives(anchors, blocks, found, k[1], *window)
                rank = 1 + np.arange(len(best.rows)) - np.searchsorted(best.rows, best.rows)
                columns = [
                    ids[found.rows[best.rows]], found.ids[best.rows], rank.astype(np.int32),
                    best.ids, found.scores[best.rows], best.scores,
                ]
                names = [field.split()[0] for field in RESULT.split(",")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return search


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
    least: int = 30, most: int = 90, block_rows: int = BLOCK_ROWS, folder: str | None = None,
) -> DataFrame:
    """Hard negatives for ``id, label, vector`` (see :func:`usable`); anchors by a condition on it.

    For each anchor and each of its first ``positives`` other rows of its label, the first
    ``negatives`` rows of other labels whose score is ``least`` to ``most`` per cent of the
    positive's. A score is the inner product; higher ones come first, of equal ones the smaller id.
    An empty table, or one without anchors, gives no rows. Shorter vectors count as filled with
    zeros. Rows repeated under one id are rows of their own, but an anchor is searched for once
    (of several, the one of the smallest label and vector) and never meets rows of its own id.
    """
    spark = rows.sparkSession
    seen = rows.agg(
        F.count("*").alias("rows"), F.count_if(is_anchor).alias("anchors"),
        F.max(F.size("vector")).alias("dims"),
        F.max(F.array_max(F.transform("vector", lambda x: F.abs(x)))).alias("largest"),
    ).first()
    if not seen["anchors"]:
        return spark.createDataFrame([], RESULT)
    shape = Shape(max(1, seen["dims"] or 0), int(seen["largest"] or 0))
    sample = (
        rows.orderBy(F.xxhash64("id", "vector")).limit(SAMPLE_ROWS).select("vector").toArrow()
    )
    curve = Curve.fit(matrix(sample.column(0).combine_chunks(), shape.dims).astype(float))
    placed = "id long, label long, vector array<bigint>, place long"
    folder = folder or work_dir(spark, "hard-negatives")
    system, path = open_folder(f"{folder}/blocks")
    system.create_dir(path, recursive=True)
    cores = spark.sparkContext.defaultParallelism
    files = max(-(-seen["rows"] // FILE_ROWS), min(2 * cores, seen["rows"] // (4 * block_rows)), 1)
    ordered = (
        map_arrow(rows, _placed(curve, shape.dims), placed)
        .repartitionByRange(files, "place", "id")
        .sortWithinPartitions("place", "id")
    )
    zones = map_arrow(ordered.drop("place"), _write_blocks(folder, shape, block_rows), ZONE)
    zones.write.mode("overwrite").parquet(f"{folder}/zones")
    slices = max(-(-seen["anchors"] // SLICE_ANCHORS), min(2 * cores, -(-seen["anchors"] // 32)))
    anchors = best_per_key(rows.filter(is_anchor), ["id"], [F.col("label"), F.col("vector")])
    near = (
        map_arrow(anchors, _placed(curve, shape.dims), placed)
        .repartitionByRange(slices, "place", "id")
        .sortWithinPartitions("place", "id")
    )
    job = _search(folder, shape, (positives, negatives), (least, most))
    return map_arrow(near.drop("place"), job, RESULT)
