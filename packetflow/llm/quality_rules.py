"""Content and boilerplate by labelling the lines of a text with a linear-chain random field.

Every line has a few yes-or-no features; the field adds their weights and a weight for each pair
of neighbouring labels, and Viterbi decoding picks the best labels of a whole text. The share of
words in content lines decides whether the text stays. Weights are fitted by gradient ascent on
the likelihood of a bounded sample of labelled documents, whose lines take the label of their
document; what good documents have too (a licence line, a short title) comes out as content.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetflow.llm.common import chunks, map_arrow
from packetflow.llm.shapes import Lines, per_text, repeated_words, split_lines

#: Bounds of the sample that the weights are fitted on: documents, and lines of a document in it.
SAMPLE_DOCUMENTS = 2000
SAMPLE_LINES = 100

#: Words in content lines that a kept text has at least, of all its words.
CONTENT_SHARE = 0.5

FEATURES = (
    "always", "no words", "fewer than four words", "symbols in over 1/4", "symbols in over 3/4",
    "bars in over 1/4", "shouts in over 1/4", "mostly capitals", "a third digits",
    "repeats an earlier line",
)


@dataclass(frozen=True)
class Field:
    """Weights of the features for content (1) against boilerplate (0), and of label pairs."""

    weights: tuple[float, ...]
    pairs: tuple[tuple[float, float], tuple[float, float]]


#: Used when there are no labels of both kinds: signs, capitals, tables and repeats are boilerplate.
UNTRAINED = Field((2, 0, 0, -3, -2, -3, -3, -3, -2, -1), ((1.0, 0.0), (0.0, 1.0)))


def line_features(lines: Lines) -> np.ndarray:
    """A row of zeros and ones for each line."""
    c = lines.counts
    words = c["words"]
    some = np.maximum(words, 1)
    points = np.maximum(c["point"] - c["space"], 1)
    columns = (
        np.ones(len(words), bool), words == 0, (words > 0) & (words < 4), c["symbol"] * 4 > some,
        c["symbol"] * 4 > 3 * some, c["bar"] * 4 > some, c["shout"] * 4 > some,
        c["upper"] * 2 > points, c["digit"] * 3 > points, lines.repeats,
    )
    return np.stack(columns, axis=1).astype(np.uint8)


def decode(features: np.ndarray, bounds: np.ndarray, field: Field) -> np.ndarray:
    """The best labels of all lines; ``bounds`` are where the texts begin, and the end."""
    score = features @ np.array(field.weights)
    (a, b), (c, d) = field.pairs
    labels = np.zeros(len(score), np.int8)
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    lengths, begins = lengths[order], bounds[:-1][order]
    active = np.searchsorted(-lengths, -np.arange(1, int(lengths.max(initial=0)) + 1), "right")
    back = []
    zero, one = np.zeros(len(lengths)), np.zeros(len(lengths))
    for t, n in enumerate(active):  # all texts that have a line number t, at once
        emission = score[begins[:n] + t]
        if t == 0:
            zero[:n], one[:n] = 0, emission
            back.append(None)
            continue
        from_zero = (zero[:n] + a, zero[:n] + b)
        from_one = (one[:n] + c, one[:n] + d)
        back.append((from_one[0] > from_zero[0], from_one[1] >= from_zero[1]))
        zero[:n] = np.maximum(from_zero[0], from_one[0])
        one[:n] = np.maximum(from_zero[1], from_one[1]) + emission
    state = one >= zero
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        labels[begins[:n] + t] = state[:n]
        if t:
            state[:n] = np.where(state[:n], back[t][1], back[t][0])
    return labels


def fit(
    sequences: list[np.ndarray], labels: list[int], rounds: int = 60, rate: float = 0.3
) -> Field:
    """Weights of highest likelihood, by gradient ascent (Adam) with a small penalty."""
    if len(set(labels)) < 2:
        return UNTRAINED
    longest = max(map(len, sequences))
    size, width = len(sequences), len(FEATURES)
    x = np.zeros((longest, size, width), np.float32)
    there = np.zeros((longest, size), bool)
    for i, features in enumerate(sequences):
        x[: len(features), i], there[: len(features), i] = features, True
    y = np.array(labels)
    weight = 1 / there.sum(axis=0)  # a document counts once, however many lines it has
    w, pair = np.zeros(width), np.zeros((2, 2))
    moments = [[np.zeros(width), np.zeros(width)], [np.zeros((2, 2)), np.zeros((2, 2))]]
    steps = there[1:].sum(axis=0)
    for step in range(1, rounds + 1):
        emission = x @ w.astype(np.float32)
        emission = np.stack([np.zeros_like(emission), emission], axis=2)
        forward = np.zeros((longest, size, 2))
        backward = np.zeros((longest, size, 2))
        forward[0] = emission[0]
        for t in range(1, longest):
            reach = forward[t - 1][:, :, None] + pair
            moved = np.logaddexp(reach[:, 0], reach[:, 1]) + emission[t]
            forward[t] = np.where(there[t][:, None], moved, forward[t - 1])
        total = np.logaddexp(forward[-1][:, 0], forward[-1][:, 1])
        expected = np.zeros((size, 2, 2))
        for t in range(longest - 1, 0, -1):
            ahead = pair + (emission[t] + backward[t])[:, None, :]
            joint = np.exp(forward[t - 1][:, :, None] + ahead - total[:, None, None])
            expected += np.where(there[t][:, None, None], joint, 0)
            moved = np.logaddexp(ahead[:, :, 0], ahead[:, :, 1])
            backward[t - 1] = np.where(there[t][:, None], moved, backward[t])
        content = np.exp(forward[:, :, 1] + backward[:, :, 1] - total) * there
        rest = (there * y - content) * weight / size
        seen = np.zeros((2, 2))
        for label in (0, 1):
            seen[label, label] = (weight * steps * (y == label)).sum() / size
        gradients = [
            np.einsum("ts,tsf->f", rest, x) - 1e-4 * w,
            seen - np.einsum("s,sij->ij", weight, expected) / size - 1e-4 * pair,
        ]
        for value, gradient, (mean, square) in zip((w, pair), gradients, moments, strict=True):
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            value += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(tuple(w.tolist()), tuple(map(tuple, pair.tolist())))


def _sample_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches):
        lines = split_lines(pc.fill_null(chunk.column("text"), ""))
        features = line_features(lines)
        bounds = np.searchsorted(lines.texts, np.arange(chunk.num_rows + 1))
        rows = [
            features[a:b].tobytes() if b - a <= SAMPLE_LINES else None
            for a, b in zip(bounds[:-1], bounds[1:], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [chunk.column("doc_id"), pa.array(rows, pa.binary()), chunk.column("label")],
            ["doc_id", "lines", "label"],
        )


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, size: int, keep=None
) -> DataFrame:
    """``doc_id, text, label`` of at most ``size`` labelled ids, half of each label where there are.

    Which ones does not depend on the order of rows: those with the smallest hash of the id. An id
    with several labels takes the largest. Ids that ``keep`` leaves out are never taken.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
    own = own.filter("doc_id IS NOT NULL AND label IN (0, 1)")
    if keep is not None:
        own = own.filter(keep)
    own = own.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    parts = [
        own.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size // 2)
        for value in (0, 1)
    ]
    chosen = parts[0].unionByName(parts[1])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.join(F.broadcast(chosen), "doc_id")


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE_DOCUMENTS) -> Field:
    """Fit the field on ``labels.quality`` of at most ``size`` documents of a bounded length."""
    sample = labelled_sample(docs, labels, "quality", size)
    rows = (
        map_arrow(sample, _sample_lines, "doc_id long, lines binary, label int")
        .filter("lines IS NOT NULL")
        .groupBy("doc_id").agg(F.min("lines").alias("lines"), F.first("label").alias("label"))
        .orderBy("doc_id").collect()
    )
    sequences = [
        np.frombuffer(r["lines"], np.uint8).reshape(-1, len(FEATURES)).astype(np.float32) for r in rows
    ]
    return fit(sequences, [r["label"] for r in rows])


def judge(text: pa.Array, field: Field, share: float) -> dict[str, np.ndarray]:
    """All columns of :func:`score_documents` for some texts."""
    text = pc.fill_null(text, "")
    number = len(text)
    lines = split_lines(text)
    counts = lines.counts
    words, repeated = repeated_words(text)
    features = line_features(lines)
    bounds = np.searchsorted(lines.texts, np.arange(number + 1))
    labels = decode(features, bounds, field)
    content = per_text(counts["words"] * labels, lines.texts, number)
    failed = (words < 50) | (100 * repeated > 50 * words)
    fraction = content / np.maximum(words, 1)
    return {
        "n_words": words.astype(np.int64),
        "word_chars": per_text(counts["point"] - counts["space"], lines.texts, number),
        "n_symbols": per_text(counts["symbol"], lines.texts, number),
        "n_dup_lines": per_text(lines.repeats, lines.texts, number),
        "n_repeat_words": repeated.astype(np.int64),
        "base_failed": failed,
        "kept": ~failed & (fraction >= share),
        "content_share": fraction,
    }


def _score(field: Field, share: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            columns = judge(chunk.column("text"), field, share)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), *map(pa.array, columns.values())], ["doc_id", *columns]
            )

    return score


def score_documents(docs: DataFrame, field: Field, share: float = CONTENT_SHARE) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept`` and ``content_share`` of every row.

    A null or empty text has no words: all counts are 0, it fails the base and is not kept. Rows
    that repeat are judged each, a null id stays null, ties of the two labels go to content. Other
    columns of ``docs`` play no part.
    """
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean, content_share double"
    )
    return map_arrow(rows, _score(field, share), schema)


def _filter(field: Field, share: float):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            yield chunk.filter(pa.array(judge(chunk.column("text"), field, share)["kept"]))

    return kept


def kept_documents(docs: DataFrame, field: Field, share: float = CONTENT_SHARE) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; nothing is shuffled."""
    return map_arrow(docs, _filter(field, share), docs.schema)
