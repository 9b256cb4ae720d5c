"""Spelling variants: words one edit apart, found by tiling dense code-point matrices.

1. *Count.* A task counts the runs of letters of each document, in chunks; partial sums leave it.
2. *Tile.* Of two words one edit apart, the longer of length m, the common prefix or the common
   suffix has at least ``m // 2`` code points. So a word stands under both halves for m = its length
   and m = its length + 1: four rows. The words under one half are a block; a block of more than
   ``BLOCK_WORDS`` is cut into several by hash, and each pair of them is a tile of its own.
3. *Compare.* A tile is a pair of padded matrices, one word to a row, aligned at the front and at
   the back. Common prefix plus common suffix of at least m - 1 is a single edit. A pair that stands
   under a common prefix and a common suffix counts under the prefix only.
4. *Choose.* A tile returns for each word the number of its near words and the best of them, never
   the pairs; sums and minima over tiles give the rest. Forms are followed by doubling.

Code points of these letters fit a byte (ASCII and U+00C0 to U+00FF), so a matrix cell is one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetflow.llm.common import Words, chunks, map_arrow, runs, split_words
from packetflow.session import shared_dir, work_dir

#: Words of a block; two blocks make a tile.
BLOCK_WORDS = 4096

#: Cells of the matrices that are compared at once.
TILE_CELLS = 1 << 22

#: Of the hash of document and run, what picks the runs that lose a code point.
EDIT_MODULUS = 97

#: Above this many bytes a run is hashed by itself.
LONG_RUN = 64


def _letters() -> np.ndarray:
    table = np.full(256, 0x20, np.uint8)
    for first, last in ((0x41, 0x5A), (0x61, 0x7A)):
        table[first : last + 1] = np.arange(first, last + 1)
    table[0x41:0x5B] += 0x20
    table[0xC3] = 0xC3
    return table


#: What each byte becomes: letters of ASCII in lower case, the lead byte of U+00C0 to U+00FF as it
#: is, all else a space.
LETTERS = _letters()


def letter_runs(text: pa.Array) -> Words:
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of several texts, A-Z in lower case."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    _, places, data = text.buffers()
    offsets = np.frombuffer(places, np.int64)[text.offset : text.offset + len(text) + 1]
    size = int(offsets[-1] - offsets[0]) if len(text) else 0
    if not size:
        return Words(np.zeros(0, np.int64), np.zeros(len(text) + 1, np.int64), pa.array([], pa.string()))
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    kept = LETTERS[raw]
    second = np.flatnonzero(raw[:-1] == 0xC3) + 1
    kept[second] = raw[second]
    spaced = pa.LargeStringArray.from_buffers(
        len(text), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(kept)
    )
    return split_words(spaced.cast(pa.string()), lower=False)


def _zero_byte() -> np.ndarray:
    """The step of crc32 over a zero byte, for each low byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


ZERO_BYTE = _zero_byte()


def pair_crc32(heads: np.ndarray, tails: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of head and tail put together, from the crc32 of each and the bytes of the tail.

    crc32 is linear: the head's is moved on by as many zero bytes as the tail has.
    """
    order = np.argsort(-lengths, kind="stable")
    moved, steps = heads[order].astype(np.uint32), lengths[order]
    for step in range(int(steps[0]) if len(steps) else 0):
        longer = int(np.searchsorted(-steps, -step, "left"))
        part = moved[:longer]
        moved[:longer] = (part >> np.uint32(8)) ^ ZERO_BYTE[part & np.uint32(0xFF)]
    result = np.empty_like(moved)
    result[order] = moved
    return result ^ tails.astype(np.uint32)


def _count(least: int, edits: int | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            found = letter_runs(chunk.column("text"))
            if not len(found.codes):
                continue
            words = found.words
            lengths = pc.utf8_length(words).to_numpy(False).astype(np.int64)
            totals = np.bincount(found.codes, minlength=len(words)).astype(np.int64)
            changed: Counter[str] = Counter()
            if edits:
                docs = np.repeat(np.arange(len(chunk)), found.counts)
                pairs, times = np.unique(docs * len(words) + found.codes, return_counts=True)
                docs, codes = np.divmod(pairs, len(words))
                ids = pc.fill_null(chunk.column("doc_id"), "").to_pylist()
                heads = [zlib.crc32(f"{i}:".encode()) for i in ids]
                spelled = words.cast(pa.binary()).to_pylist()
                tails = np.fromiter(map(zlib.crc32, spelled), np.uint32, len(spelled))
                sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))[codes]
                hashes = np.empty(len(codes), np.uint32)
                short = sizes <= LONG_RUN
                hashes[short] = pair_crc32(
                    np.array(heads, np.uint32)[docs[short]], tails[codes[short]], sizes[short]
                )
                for at in np.flatnonzero(~short):
                    hashes[at] = zlib.crc32(spelled[codes[at]], heads[docs[at]])
                for at in np.flatnonzero(hashes % edits == 0):
                    code = int(codes[at])
                    word = spelled[code].decode()
                    cut = int(hashes[at]) % len(word)
                    totals[code] -= times[at]
                    changed[word[:cut] + word[cut + 1 :]] += int(times[at])
            keep = np.flatnonzero((lengths >= least) & (totals > 0))
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(keep)).cast(pa.string()), pa.array(totals[keep])], ["word", "n"]
            )
            edited = [(w, n) for w, n in changed.items() if len(w) >= least]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w for w, _ in edited], pa.string()),
                    pa.array([n for _, n in edited], pa.int64()),
                ],
                ["word", "n"],
            )

    return count


def word_counts(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = 5,
    least_count: int = 3, edits: int | None = None,
) -> DataFrame:
    """``word, n``: runs of letters in lower case and how often each occurs.

    Null and empty texts have none; columns other than the two named are not looked at. With
    ``edits``, a run of a document whose crc32 of ``<doc_id>:<run>`` that number divides loses the
    code point at that crc32 modulo its length (typing errors of a known kind, for measurements); a
    null id is an empty one there.
    """
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    found = map_arrow(rows, _count(least_length, edits), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _tiles(words: DataFrame, block_words: int) -> DataFrame:
    """Each word in every tile it has to be compared in; large blocks are cut into several."""
    halves = [
        F.struct(
            F.lit(side).alias("side"),
            longer.cast("int").alias("longer"),
            half(F.floor(longer / 2).cast("int")).alias("half"),
        )
        for longer in (F.length("word"), F.length("word") + 1)
        for side, half in (
            ("p", lambda n: F.substring(F.col("word"), F.lit(1), n)),
            ("s", lambda n: F.right(F.col("word"), n)),
        )
    ]
    key = ["side", "longer", "half"]
    rows = words.select("word", "n", F.inline(F.array(*halves)))
    sizes = rows.groupBy(*key).agg(F.count("*").alias("__rows"))
    large = sizes.filter(F.col("__rows") > block_words).select(
        *key, F.ceil(F.col("__rows") / block_words).cast("int").alias("blocks")
    )
    cut = rows.join(large, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    spread = cut.withColumn("block", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    return spread.select(
        "word", "n", *key, "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )


def _matrices(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """One word to a row, aligned at the front and at the back; zero is no letter."""
    front = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
    back = np.frombuffer(b"".join(w.rjust(width, b"\0") for w in words), np.uint8)
    return front.reshape(-1, width), back.reshape(-1, width)


def _near(words: list[bytes], side: str, longer: int, left: np.ndarray, right: np.ndarray):
    """Pairs of rows one edit apart, each pair once; ``left`` is compared with ``right``.

    Where both are the same rows, only those behind a row are compared with it.
    """
    front, back = _matrices(words, longer)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    half = longer // 2
    part = slice(half, None) if side == "p" else slice(None, longer - half)
    rest_front, rest_back = front[:, part], np.ascontiguousarray(back[:, part][:, ::-1])
    rest = longer - half
    same = left is right
    step = max(1, TILE_CELLS // (rest * max(len(right), 1)))
    for begin in range(0, len(left), step):
        rows = left[begin : begin + step]
        if same:
            columns = right[begin + 1 :]
            over = np.arange(len(rows))[:, None] <= np.arange(len(columns))[None, :]
        else:
            columns = right
            over = np.ones((len(rows), len(columns)), bool)
        # two of the shorter length are compared under the halves of that length
        over &= (sizes[rows] == longer)[:, None] | (sizes[columns] == longer)[None, :]
        a, b = np.nonzero(over)
        a, b = rows[a], columns[b]
        pairs = max(1, TILE_CELLS // rest)
        for at in range(0, len(a), pairs):
            i, j = a[at : at + pairs], b[at : at + pairs]
            prefix = _common(rest_front[i] != rest_front[j], rest)
            close = prefix + _common(rest_back[i] != rest_back[j], rest) >= rest - 1
            i, j = i[close], j[close]
            if side == "s" and len(i):
                apart = (front[i, :half] != front[j, :half]).any(axis=1)
                i, j = i[apart], j[apart]
            if len(i):
                yield i, j


def _common(differ: np.ndarray, width: int) -> np.ndarray:
    """Cells before the first difference of each row."""
    first = differ.argmax(axis=1)
    return np.where(differ[np.arange(len(first)), first], first, width)


def _compare(tile: pa.Table) -> pa.RecordBatch:
    """For each word of one tile the number of near words and the best of them."""
    words = [w.encode("latin-1") for w in tile.column("word").to_pylist()]
    counts = tile.column("n").to_numpy()
    block = tile.column("block").to_numpy()
    head = {name: tile.column(name)[0].as_py() for name in ("side", "longer", "low", "high")}
    if head["low"] == head["high"]:
        left = right = np.arange(len(words))
    else:
        left, right = np.flatnonzero(block == head["low"]), np.flatnonzero(block == head["high"])
    found = list(_near(words, head["side"], head["longer"], left, right))
    if not found:
        return _result([], [], [], [])
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    i, j = np.concatenate([i, j]), np.concatenate([j, i])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[j], -counts[j], i))
    i, j = i[order], j[order]
    bounds = runs(i)
    first = bounds[:-1]
    return _result(
        [words[x].decode("latin-1") for x in i[first]], np.diff(bounds), counts[j[first]],
        [words[x].decode("latin-1") for x in j[first]],
    )


NEAR = "word string, n_near long, near_n long, near string"


def _result(word, n_near, near_n, near) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(word, pa.string()), pa.array(n_near, pa.int64()),
            pa.array(near_n, pa.int64()), pa.array(near, pa.string()),
        ],
        ["word", "n_near", "near_n", "near"],
    )


def _compare_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles of rows that come sorted; a tile may go on in the next batch.

    Words that are alone in a tile are not compared. Small results are put together.
    """
    held: list[pa.RecordBatch] = []
    ready: list[pa.RecordBatch] = []

    def finish(last: bool = False) -> Iterator[pa.RecordBatch]:
        if ready and (last or len(ready) >= 1000):
            yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
            ready.clear()

    for batch in batches:
        tile = np.stack([batch.column(c).to_numpy() for c in ("tile_a", "tile_b")], axis=1)
        new = (tile[1:] != tile[:-1]).any(axis=1)
        bounds = [0, *(np.flatnonzero(new) + 1).tolist(), len(batch)]
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            if begin == end:
                continue
            part = batch.slice(begin, end - begin)
            if held and any(
                held[0].column(c)[0] != part.column(c)[0] for c in ("tile_a", "tile_b")
            ):
                rows = pa.Table.from_batches(held)
                held = []
                if len(rows) > 1:
                    ready.append(_compare(rows))
                    yield from finish()
            held.append(part)
    if held and (rows := pa.Table.from_batches(held)).num_rows > 1:
        ready.append(_compare(rows))
    yield from finish(last=True)


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, n_near, near_n, near``: how many words of ``word, n`` are one edit apart and the best.

    The best is the one of largest n, of equal ones the smallest in code-point order. Words are
    distinct, of ASCII letters and U+00C0 to U+00FF; words without a near one have no row.
    """
    tiles = _tiles(words, block_words)
    where = ["side", "longer", "half", "low", "high"]
    # two hashes name the tile: one would let two tiles fall together among very many
    named = tiles.withColumns({"tile_a": F.xxhash64(*where), "tile_b": F.hash(*where).cast("long")})
    sorted_rows = (
        named.drop("half").repartition("tile_a").sortWithinPartitions("tile_a", "tile_b")
    )
    found = map_arrow(sorted_rows, _compare_all, NEAR)
    best = F.min(F.struct((-F.col("near_n")).alias("key"), F.col("near"))).alias("best")
    return (
        found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
        .select("word", "n_near", (-F.col("best.key")).alias("near_n"), F.col("best.near").alias("near"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: where following forms from a word ends.

    Every round doubles the steps that are followed. A form occurs more often than its word, so
    there is no circle, and as many rounds as the logarithm of the longest chain.
    """
    shared_dir(forms.sparkSession)
    current = forms.select("word", F.col("form").alias("root")).checkpoint()
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        joined = current.join(further, "root", "left").select(
            "word", F.coalesce("__next", "root").alias("root"),
            F.col("__next").isNotNull().alias("__moved"),
        ).checkpoint()
        moved = joined.filter("__moved").limit(1).count()
        current = joined.drop("__moved")
        if not moved:
            return current


def variants(words: DataFrame, factor: int = 2, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for words with their counts ``n``.

    A word's form is its best near word if that occurs at least ``factor`` times as often; ``root``
    is where following forms ends, the word itself without a form. An empty table gives none.
    """
    folder = work_dir(words.sparkSession, "spelling")
    words.select("word", "n").write.parquet(f"{folder}/words")
    words = words.sparkSession.read.schema("word string, n long").parquet(f"{folder}/words")
    near_words(words, block_words).write.parquet(f"{folder}/near")
    near = words.sparkSession.read.schema(NEAR).parquet(f"{folder}/near")
    enough = F.col("near_n") >= factor * F.col("n")
    with_near = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("near")).alias("form"),
        F.when(enough, F.col("near_n")).alias("form_n"),
    )
    ends = roots(with_near.filter("form IS NOT NULL"))
    return with_near.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
