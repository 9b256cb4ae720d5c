"""Perplexity under an interpolated modified Kneser-Ney model of word pairs.

Counted in Spark, kept as sorted hash arrays in the shared folder, memory-mapped by the tasks that
score. The arrays are cut into shards by the top bits of the hash; their number follows the size of
the input, so no task ever holds more than its share, and none of it passes the driver. A frequent
context is spread over all shards, since its pairs are dealt out by the hash of the pair.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetflow.llm.common import (
    by_shard,
    chunks,
    grouped_arrow,
    hash_words,
    joined,
    map_arrow,
    mixed,
    model_folder,
    runs,
    shard_bits,
    split_words,
    window_hashes,
)

#: Bytes of a word's hash that are kept: with 10^9 words, two in 500,000 share one with another.
HASH_BYTES = 6
_KEPT = np.uint64(2**64 - 2 ** (64 - 8 * HASH_BYTES))

#: Stand for the place before the first word and for the end of a text; no word has white space.
BEGIN, END = hash_words(pa.array([" begin", " end"])) & _KEPT

#: Bytes of text whose pairs are counted together before they are dealt out.
COUNT_BYTES = 6 << 20


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the few numbers that hold for all of them."""

    folder: str
    bits: int
    tokens: int
    words: int
    pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_backoff: float


def _sequence(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context and word of every token as ranks of sorted hashes, the hashes, text numbers."""
    words = split_words(text)
    table = np.concatenate([[BEGIN, END], hash_words(words.words) & _KEPT]).astype(np.uint64)
    lengths = words.counts + 1
    ends = np.cumsum(lengths)
    codes = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    inner = np.ones(len(codes), bool)
    inner[ends - 1] = False
    codes[inner] = words.codes + 2
    codes[ends - 1] = 1
    before = np.empty_like(codes)
    before[1:] = codes[:-1]
    before[ends - lengths] = 0
    return before, codes, table, np.repeat(np.arange(len(lengths)), lengths)


def _packed(hashes: np.ndarray) -> bytes:
    return hashes.view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BYTES :].tobytes()


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    stored = joined(column, np.uint8).reshape(-1, HASH_BYTES)
    whole = np.zeros((len(stored), 8), np.uint8)
    whole[:, 8 - HASH_BYTES :] = stored
    return whole.view(np.uint64).ravel()


def _pair_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    both = np.concatenate([context, word])
    starts = np.arange(len(context))
    # a window over two rows laid side by side
    return window_hashes(both.reshape(2, -1).T.ravel(), starts * 2, 2)


def _count_pairs(bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, limit=COUNT_BYTES):
            before, codes, table, _ = _sequence(chunk.column("text"))
            if not len(codes):
                continue
            keys, counts = np.unique(before * len(table) + codes, return_counts=True)
            context, word = table[keys // len(table)], table[keys % len(table)]
            shards = (_pair_hash(context, word) >> np.uint64(64 - bits)).astype(np.int32)
            for shard, rows in by_shard(shards):
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "shard": shard,
                            "context": _packed(context[rows]),
                            "word": _packed(word[rows]),
                            "n": counts[rows].astype(np.uint32).tobytes(),
                        }
                    ],
                    _PAIRS,
                )

    return count


_PAIRS = pa.schema(
    [("shard", pa.int32()), ("context", pa.binary()), ("word", pa.binary()), ("n", pa.binary())]
)
_PAIRS_SQL = "shard int, context binary, word binary, n binary"
_WORDS_SQL = "shard int, word binary, stats binary, n1 long, n2 long, n3 long, n4 long"
_TOTAL_NAMES = (
    "tokens", "words", "kinds", *(f"n{i}" for i in range(1, 5)), *(f"pairs{i}" for i in range(1, 5))
)
_TOTALS_SQL = ", ".join(f"{name} long" for name in _TOTAL_NAMES)


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Write a whole file, then name it: a task that runs twice leaves the same file."""
    path = os.path.join(folder, name)
    temporary = f"{path}.{uuid.uuid4().hex}"
    with open(temporary, "wb") as file:
        np.save(file, array)
    os.replace(temporary, path)


def _save_table(folder: str, name: str, shard: int, keys: np.ndarray, values: np.ndarray) -> None:
    """Sorted keys and a row of numbers for each; those with small numbers take a byte a number."""
    large = values.max(axis=1, initial=0) > 255
    for kind, rows, dtype in (("rare", ~large, np.uint8), ("frequent", large, np.int64)):
        _save(folder, f"{name}-{kind}-keys-{shard}.npy", keys[rows])
        _save(folder, f"{name}-{kind}-values-{shard}.npy", values[rows].astype(dtype))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else values[:0]


def _merge_pairs(folder: str, bits: int):
    """Of one shard: write pairs and counts; return what it knows of contexts and words."""

    def merge(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        context, word = _unpacked(group.column("context")), _unpacked(group.column("word"))
        n = joined(group.column("n"), np.uint32)
        hashes = _pair_hash(context, word)
        order = np.argsort(hashes)
        hashes = hashes[order]
        starts = runs(hashes)[:-1]
        counts = _sums(n[order].astype(np.int64), starts)
        context, word, hashes = context[order][starts], word[order][starts], hashes[starts]
        os.makedirs(folder, exist_ok=True)
        _save_table(folder, "pair", shard, hashes, counts.reshape(-1, 1))

        # as a context: occurrences, and kinds of followers seen once, twice, more often
        kinds, place = np.unique(np.concatenate([context, word]), return_inverse=True)
        stats = np.zeros((len(kinds), 5), np.int64)
        left, right = place[: len(context)], place[len(context) :]
        stats[:, 0] = np.bincount(left, counts, len(kinds))
        for i, seen in enumerate((counts == 1, counts == 2, counts > 2), 1):
            stats[:, i] = np.bincount(left[seen], minlength=len(kinds))
        stats[:, 4] = np.bincount(right, minlength=len(kinds))  # kinds of contexts before the word
        rows = []
        shards = (kinds >> np.uint64(64 - bits)).astype(np.int32)
        for target, members in by_shard(shards):
            rows.append(
                {
                    "shard": target,
                    "word": _packed(kinds[members]),
                    "stats": stats[members].tobytes(),
                }
            )
        for i in range(1, 5):
            rows[0][f"n{i}"] = int((counts == i).sum())
        return pa.Table.from_pylist(rows, _WORDS)

    return merge


_WORDS = pa.schema(
    [("shard", pa.int32()), ("word", pa.binary()), ("stats", pa.binary())]
    + [(name, pa.int64()) for name in ("n1", "n2", "n3", "n4")]
)
_TOTALS = pa.schema([(name, pa.int64()) for name in _TOTAL_NAMES])


def _merge_words(folder: str):
    """Of one shard of words: write what is known of them; return sums over it."""

    def merge(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        word = _unpacked(group.column("word"))
        stats = joined(group.column("stats"), np.int64).reshape(-1, 5)
        order = np.argsort(word)
        word = word[order]
        starts = runs(word)[:-1]
        stats = np.add.reduceat(stats[order], starts, axis=0)
        word = word[starts]
        _save_table(folder, "word", shard, word, stats)
        before, texts = stats[:, 4], int(stats[word == BEGIN, 0].sum())
        # an end is never a context: it occurs as often as a beginning
        real = (word != BEGIN) & (word != END)
        totals = {
            "tokens": int(stats[real, 0].sum()) + texts,
            "words": int((before > 0).sum()),
            "kinds": int(before.sum()),
        }
        for i in range(1, 5):
            totals[f"n{i}"] = int((before == i).sum())
            totals[f"pairs{i}"] = pc.sum(group.column(f"n{i}")).as_py() or 0
        return pa.Table.from_pylist([totals], _TOTALS)

    return merge


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What is taken off counts of one, two, and three or more, from the counts of counts."""
    if not n1 or not n2:
        return (0.5, 0.5, 0.5)
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return (min(max(d1, 0.0), 1.0), min(max(d2, 0.0), 2.0), min(max(d3, 0.0), 3.0))


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count all texts of ``docs`` (null: an empty one) and write the arrays of the model."""
    spark = docs.sparkSession
    folder = model_folder(spark, "ngram-lm")
    texts = docs.select(F.col(text).alias("text"))
    bits = shard_bits(texts)
    pairs = map_arrow(texts, _count_pairs(bits), _PAIRS_SQL)
    parts = grouped_arrow(pairs, "shard", _merge_pairs(folder, bits), _WORDS_SQL)
    totals = (
        grouped_arrow(parts, "shard", _merge_words(folder), _TOTALS_SQL)
        .agg(*[F.sum(c).alias(c) for c in _TOTAL_NAMES])
        .first()
    )
    value = {name: int(totals[name] or 0) for name in _TOTAL_NAMES}
    word_discounts = discounts(*[value[f"n{i}"] for i in range(1, 5)])
    frequent = value["words"] - value["n1"] - value["n2"]
    taken = np.dot(word_discounts, (value["n1"], value["n2"], frequent))
    return Model(
        folder, bits, value["tokens"], value["words"], value["kinds"],
        discounts(*[value[f"pairs{i}"] for i in range(1, 5)]), word_discounts,
        float(taken) / value["kinds"] if value["kinds"] else 1.0,
    )


class _Arrays:
    """The arrays of a model as a task sees them: mapped, not read."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}

    def mapped(self, name: str, shard: int) -> np.ndarray | None:
        key = (name, shard)
        if key not in self.open:
            path = os.path.join(self.model.folder, f"{name}-{shard}.npy")
            self.open[key] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        return self.open[key]

    def find(self, keys: np.ndarray, name: str, width: int) -> np.ndarray:
        """The numbers of sorted ``keys``; zeros for those that are not stored."""
        found = np.zeros((len(keys), width), np.int64)
        shards = (keys >> np.uint64(64 - self.model.bits)).astype(np.int64)
        bounds = runs(shards)
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            for kind in ("rare", "frequent"):
                stored = self.mapped(f"{name}-{kind}-keys", int(shards[begin]))
                if stored is None or not len(stored):
                    continue
                place = np.minimum(np.searchsorted(stored, keys[begin:end]), len(stored) - 1)
                hit = np.flatnonzero(stored[place] == keys[begin:end])
                values = self.mapped(f"{name}-{kind}-values", int(shards[begin]))
                found[begin + hit] = values[place[hit]]
        return found


def _discounted(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    off = np.array((0.0, *by))[np.minimum(counts, 3)]
    return np.maximum(counts - off, 0.0)


def _score(model: Model, names: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _Arrays(model)
        for chunk in chunks(batches, limit=COUNT_BYTES):
            before, codes, table, texts = _sequence(chunk.column("text"))
            rows = chunk.num_rows
            order = np.argsort(table)
            stats = np.empty((len(table), 5), np.int64)
            stats[order] = arrays.find(table[order], "word", 5)
            total, before_kinds = stats[:, 0].copy(), stats[:, 4]
            texts_seen, total[0] = total[0], 0
            own = total.copy()
            own[1] = texts_seen
            total[0] = texts_seen
            base = np.log10((own + 1) / (model.tokens + model.words + 1))
            kinds = max(model.pairs, 1)  # each kind of pair is one kind of context before a word
            single = _discounted(before_kinds, model.word_discounts) / kinds
            single = single + model.word_backoff / (model.words + 1)
            spared = stats[:, 1:4] @ np.array(model.pair_discounts)
            weight = np.where(total > 0, spared / np.maximum(total, 1), 1.0)

            keys, place = np.unique(before * len(table) + codes, return_inverse=True)
            left, right = keys // len(table), keys % len(table)
            hashes = _pair_hash(table[left], table[right])
            order = np.argsort(hashes)
            counts = np.empty(len(keys), np.int64)
            counts[order] = arrays.find(hashes[order], "pair", 1)[:, 0]
            known = _discounted(counts, model.pair_discounts) / np.maximum(total[left], 1)
            logs = np.log10(known + weight[left] * single[right])
            columns = {
                "n_tokens": np.bincount(texts, minlength=rows).astype(np.int64),
                "n_known": np.bincount(texts, own[codes] > 0, rows).astype(np.int64),
                "base_score": np.bincount(texts, base[codes], rows),
                "score": np.bincount(texts, logs[place], rows),
            }
            kept = [chunk.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                kept + [pa.array(v) for v in columns.values()], names + list(columns)
            )

    return score


def score_documents(
    docs: DataFrame, model: Model, text: str = "text", keep: tuple[Column, ...] = ()
) -> DataFrame:
    """``keep``, then ``n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Lower-cased words and one end are the tokens of a text; null is the empty text, whose only
    token is its end. ``score`` is the log10 probability of the tokens, each given the one before;
    probabilities of all known words and one unknown word add up to one after any context. A
    context that was never seen leaves the choice to the single words. Equal texts score alike;
    repeated rows are scored each. With nothing learned the probability of every token is 1.
    """
    kept = docs.select(*keep)
    rows = docs.select(*keep, F.col(text).alias("text"))
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields)
    schema = types + "n_tokens long, n_known long, base_score double, score double"
    scored = map_arrow(rows, _score(model, kept.columns), schema)
    return scored.select(
        *kept.columns, "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
