"""Benchmark decontamination by greedy string tiling.

The test items are cut into slices of bounded size. Every document is scanned once for each slice:
windows of a few words that an item has too are the seeds. Where seeds could cover enough of an
item, tiles are laid: the longest run of words that both still have free is found with Karp-Rabin
hashes of windows, which one step over the words gives for any length; its places are marked in
both from left to right, and so on down to the shortest length. The
share of the item under tiles, in whatever order they stand in the document, decides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from packetflow.llm.common import (
    Words,
    chunks,
    hash_words,
    map_arrow,
    runs,
    split_words,
    window_hashes,
    window_starts,
)
from packetflow.session import work_dir

#: Characters of test items that are broadcast at once; more items are further slices.
SLICE_CHARS = 16_000_000

#: Shortest run of words that counts as a tile, and the share of an item's words under tiles.
MIN_MATCH = 4
COVERAGE = 0.5

_NO_LETTERS = r"[^\pL\pN]+"


def bare_words(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text begins.

    Case and all that is not a letter or digit are left out; what is nothing but that is no word.
    """
    words = split_words(text, lower=False)
    bare = pc.replace_substring_regex(pc.utf8_lower(words.words), _NO_LETTERS, "")
    hashes = hash_words(bare)
    full = pc.not_equal(bare, "").to_numpy(False)
    keep = full[words.codes]
    offsets = np.concatenate([[0], np.cumsum(keep)])[words.offsets]
    return hashes[words.codes[keep]], offsets


class Items:
    """Test items as arrays, with an index from each seed to the places of items that have it.

    Seeds are windows of ``min_match`` words; an item of fewer words has one, the whole of it.
    """

    def __init__(self, ids: list, texts: list[str | None], min_match: int):
        self.hashes, self.offsets = bare_words(pa.array(texts, pa.string()))
        self.ids, self.min_match = ids, min_match
        self.sizes = np.diff(self.offsets)
        words = Words(np.arange(len(self.hashes)), self.offsets, pa.array([], pa.string()))
        self.index: dict[int, tuple[np.ndarray, ...]] = {}
        for width in np.unique(np.minimum(self.sizes, min_match)).tolist():
            if not width:
                continue
            starts, items = window_starts(words, width)
            if width < min_match:  # only those that have no longer window
                own = self.sizes[items] == width
                starts, items = starts[own], items[own]
            seeds = window_hashes(self.hashes, starts, width)
            order = np.argsort(seeds, kind="stable")
            bounds = runs(seeds[order])
            self.index[width] = (
                seeds[order][bounds[:-1]], bounds, items[order].astype(np.int32),
                (starts - self.offsets[items])[order].astype(np.int32),
            )

    def words(self, item: int) -> np.ndarray:
        return self.hashes[self.offsets[item] : self.offsets[item + 1]]


#: An odd number to whose powers words are added up, and its inverse among 64-bit numbers.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, most: int) -> np.ndarray:
    factors = np.full(most + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class KarpRabin:
    """Hashes of all windows of one width, for any width, in one step over the words each."""

    def __init__(self, words: np.ndarray):
        self.words = words
        powers, self.back = (_powers(x, len(words)) for x in (BASE, INVERSE))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers[:-1])])

    def hashes(self, starts: np.ndarray, width: int) -> np.ndarray:
        return (self.sums[starts + width] - self.sums[starts]) * self.back[starts]


def tiles(
    text: np.ndarray, item: np.ndarray, min_match: int
) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(place in text, place in item, length)``, longest first.

    Of tiles of one length the first in the text comes first, at the first free place of the item.
    Each length is one pass over the words, however often they repeat.
    """
    sides = KarpRabin(text), KarpRabin(item)
    free = np.ones(len(text), bool), np.ones(len(item), bool)
    longest, found = min(len(text), len(item)), []

    def windows(width: int) -> list[tuple[np.ndarray, np.ndarray]]:
        result = []
        for side, open_ in zip(sides, free, strict=True):
            taken = np.concatenate([[0], np.cumsum(~open_)])
            starts = np.arange(len(open_) - width + 1)
            starts = starts[taken[starts + width] == taken[starts]]
            result.append((starts, side.hashes(starts, width)))
        return result

    while longest >= min_match:
        low, high = min_match - 1, longest  # a common free run of n words has one of n - 1
        while low < high:
            middle = (low + high + 1) // 2
            (_, ours), (_, theirs) = windows(middle)
            if np.isin(theirs, ours).any():
                low = middle
            else:
                high = middle - 1
        if low < min_match:
            break
        found += _lay(text, item, free, low, *windows(low))
        longest = low - 1  # no two free windows of this width are left
    return found


def _lay(text, item, free, width: int, ours, theirs) -> list[tuple[int, int, int]]:
    """Mark equal windows from left to right; a place of the item is looked at once for each hash."""
    places: dict[int, list[int]] = defaultdict(list)
    hit = np.isin(theirs[1], ours[1])
    for j, h in zip(theirs[0][hit][::-1].tolist(), theirs[1][hit][::-1].tolist(), strict=True):
        places[h].append(j)  # the first place comes last
    hit = np.isin(ours[1], theirs[1])
    laid, next_free, left = [], 0, len(places)
    for i, h in zip(ours[0][hit].tolist(), ours[1][hit].tolist(), strict=True):
        if not left:
            break
        waiting, others = places[h], []
        if i < next_free or not waiting:
            continue
        while waiting:
            j = waiting.pop()
            if not free[1][j : j + width].all():
                continue  # it will not be free again
            if (text[i : i + width] != item[j : j + width]).any():
                others.append(j)  # equal by hash only
                continue
            free[0][i : i + width] = free[1][j : j + width] = False
            laid.append((i, j, width))
            next_free = i + width
            break
        else:
            left -= not others
        waiting.extend(reversed(others))
    return laid


#: Places of seeds in items that are looked at together.
MAX_PLACES = 1 << 22


def find_items(text: pa.Array, items: Items, coverage: float) -> Iterator[tuple]:
    """``(text, item, tiles, words under tiles, words of the item)`` of all that reach the share.

    First the words of each item that lie under a seed of the text are counted, for all items at
    once; only where they reach the share tiles are laid.
    """
    hashes, offsets = bare_words(text)
    words = Words(np.arange(len(hashes)), offsets, pa.array([], pa.string()))
    for width, (seeds, bounds, item_of, place_of) in items.index.items():
        starts, texts = window_starts(words, width)
        found = window_hashes(hashes, starts, width)
        seed = np.minimum(np.searchsorted(seeds, found), len(seeds) - 1)
        hit = seeds[seed] == found
        starts, texts, seed = starts[hit], texts[hit], seed[hit]
        # each seed of a text once, in the order of texts
        pairs = np.unique(texts * len(seeds) + seed)
        pair_text, pair_seed = np.divmod(pairs, len(seeds))
        sizes = bounds[pair_seed + 1] - bounds[pair_seed]
        for part in _whole_texts(pair_text, sizes):
            of = np.repeat(np.arange(part.start, part.stop), sizes[part])
            first = np.cumsum(sizes[part]) - sizes[part]
            at = np.arange(len(of)) - np.repeat(first - bounds[pair_seed[part]], sizes[part])
            order = np.lexsort((place_of[at], item_of[at], pair_text[of]))
            number, item = pair_text[of][order], item_of[at][order].astype(np.int64)
            place = place_of[at][order].astype(np.int64)
            ends = runs(number * len(items.ids) + item)
            gaps = np.full(len(place), width)
            gaps[:-1] = np.minimum(width, np.diff(place))
            gaps[ends[1:] - 1] = width
            under = np.add.reduceat(gaps, ends[:-1]) if len(gaps) else gaps
            enough = under >= coverage * items.sizes[item[ends[:-1]]]
            for row in ends[:-1][enough].tolist():
                wanted = items.words(item[row])
                begin, end = np.searchsorted(texts, [number[row], number[row] + 1])
                own = starts[begin:end] - offsets[number[row]]
                own_seeds = window_hashes(wanted, np.arange(len(wanted) - width + 1), width)
                own = own[np.isin(seeds[seed[begin:end]], own_seeds)]
                whole = hashes[offsets[number[row]] : offsets[number[row] + 1]]
                laid = tiles(_under(whole, own, width), wanted, width)
                covered = sum(length for _, _, length in laid)
                if covered >= coverage * len(wanted):
                    yield int(number[row]), int(item[row]), len(laid), covered, len(wanted)


def _whole_texts(text: np.ndarray, sizes: np.ndarray) -> Iterator[slice]:
    """Slices of rows of about ``MAX_PLACES`` in all, or of one text."""
    ends = runs(text)[1:]
    total = np.concatenate([[0], np.cumsum(sizes)])
    begin = 0
    while begin < len(text):
        most = int(np.searchsorted(total[ends], total[begin] + MAX_PLACES, "right"))
        end = int(ends[max(most - 1, np.searchsorted(ends, begin, "right"))])
        yield slice(begin, end)
        begin = end


def _under(words: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """The words under windows, with a gap for what lies between: nothing else can be in a tile."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(change) > 0])))
    gap, parts = np.zeros(1, np.uint64), []
    for begin, end in zip(edges[::2], edges[1::2], strict=True):
        parts += [words[begin:end], gap]
    return np.concatenate(parts)


def _find(items: Broadcast, coverage: float, schema: pa.Schema):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            ids = chunk.column("doc_id")
            rows = [
                (ids[number].as_py(), items.value.ids[item], *counts)
                for number, item, *counts in find_items(chunk.column("text"), items.value, coverage)
            ]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(schema.names, row, strict=True)) for row in rows], schema
            )

    return find


def _clean(items: Broadcast, coverage: float, text: str):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, text):
            keep = np.ones(chunk.num_rows, bool)
            for number, *_ in find_items(chunk.column(text), items.value, coverage):
                keep[number] = False
            yield chunk.filter(pa.array(keep))

    return clean


def _slices(benchmark: DataFrame, item_id: str, text: str, min_match: int, slice_chars: int):
    """Broadcasts of the test items one after the other, each of about ``slice_chars`` at most.

    Yields how many there are, too. Only one is built and held at a time.
    """
    items = benchmark.select(
        F.col(item_id).alias("item_id"), F.col(text).alias("text")
    ).filter("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    number = -(-size * 2 // slice_chars) if size > slice_chars else 1
    own = F.pmod(F.xxhash64("item_id", "text"), F.lit(number))
    for i in range(number):
        rows = items.filter(own == i).distinct().orderBy("item_id", "text").collect()
        found = Items([r[0] for r in rows], [r[1] for r in rows], min_match)
        yield number, benchmark.sparkSession.sparkContext.broadcast(found)


def _written(part: DataFrame, path: str, items: Broadcast) -> DataFrame:
    """The part as a table, after which its items are needed no more."""
    part.write.parquet(path)
    items.destroy()
    return part.sparkSession.read.schema(part.schema).parquet(path)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE,
    doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    slice_chars: int = SLICE_CHARS,
) -> DataFrame:
    """``doc_id, item_id, n_tiles, n_covered, n_item_words`` of each document and item it holds.

    A document holds an item if at least ``coverage`` of the item's words lie under tiles of
    ``min_match`` words or more. An item of fewer words is one tile. Null and empty texts, and items
    without a word, hold nothing and are held by nothing; no items give no rows. Ids are of any
    type; null ones stay null; each row that repeats a document reports for itself, items repeated
    whole count once. Columns of other names play no part. With several slices of items, what one
    finds is written to the shared folder before the next is built.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    fields = [StructField("doc_id", base.schema["doc_id"].dataType)]
    fields += [StructField("item_id", benchmark.schema[item_id].dataType)]
    fields += [StructField(n, LongType()) for n in ("n_tiles", "n_covered", "n_item_words")]
    schema, result = StructType(fields), None
    folder = work_dir(spark, "decontamination")
    for i, (number, items) in enumerate(_slices(benchmark, item_id, text, min_match, slice_chars)):
        part = map_arrow(base, _find(items, coverage, to_arrow_schema(schema)), schema)
        if number > 1:
            part = _written(part, f"{folder}/{i}", items)
        result = part if result is None else result.unionByName(part)
    return result


def without_items(
    docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE,
    text: str = "text", slice_chars: int = SLICE_CHARS,
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; nothing is shuffled.

    With several slices of items, what one leaves is written before the next is built.
    """
    folder = work_dir(docs.sparkSession, "decontamination")
    for i, (number, items) in enumerate(
        _slices(benchmark, "item_id", "text", min_match, slice_chars)
    ):
        docs = map_arrow(docs, _clean(items, coverage, text), docs.schema)
        if number > 1:
            docs = _written(docs, f"{folder}/{i}", items)
    return docs
