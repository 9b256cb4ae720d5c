"""Toxicity by weak supervision.

Voters are lexicon entries (words and beginnings of words that labelled toxic documents have more
often by far) and patterns of their hits. A generative model says how often each voter speaks up on
toxic and on clean documents; its accuracies are estimated by expectation maximization, with the
given label as one more voter that may be wrong. Voters that agree beyond what the label explains
(correlations within a label) share their weight. A linear classifier is fitted on the posterior
labels and scores every text from counts of the hits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetflow.llm.common import chunks, map_arrow, split_words
from packetflow.llm.logistic import Logistic, sigmoid
from packetflow.llm.quality_rules import labelled_sample

#: Labelled documents that lexicon, label model and classifier are learned from.
SAMPLE_DOCUMENTS = 8000

#: Entries of the lexicon; lengths of beginnings; how much more often toxic documents have them.
ENTRIES = 64
PREFIXES = (4, 5, 6, 7)
LIFT = 8.0
LEAST_DOCUMENTS = 4

#: Words between two hits that are near each other.
NEAR = 25

_NO_LETTERS = r"[^\pL\pN]+"
PATTERNS = ("any hit", "two entries", "three hits", "hits near each other", "one hit in 200 words")


def _bare(words: pa.Array) -> list[str]:
    return pc.replace_substring_regex(pc.utf8_lower(words), _NO_LETTERS, "").to_pylist()


def _entries_of(word: str) -> Iterator[str]:
    """The entries a word can hit: itself, marked by =, and its beginnings."""
    yield "=" + word
    for length in PREFIXES:
        if len(word) > length:
            yield word[:length]


def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches):
        words = split_words(chunk.column("text"), lower=False)
        bare = _bare(words.words)
        labels = chunk.column("label").to_pylist()
        counts = (Counter(), Counter())
        for i, label in enumerate(labels):
            codes = words.codes[words.offsets[i] : words.offsets[i + 1]]
            own = {bare[c] for c in set(codes.tolist())}
            counts[label].update({e for w in own if len(w) > 2 for e in _entries_of(w)})
        names = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string())]
            + [pa.array([counts[label][e] for e in names], pa.int64()) for label in (0, 1)],
            ["entry", "clean", "toxic"],
        )


@dataclass(frozen=True)
class Lexicon:
    entries: tuple[str, ...]

    def __post_init__(self):
        object.__setattr__(self, "_index", {e: i for i, e in enumerate(self.entries)})

    def match(self, words: list[str]) -> np.ndarray:
        """The entry that each word hits, the most special one, or -1."""
        index, found = self._index, np.full(len(words), -1, np.int64)
        for i, word in enumerate(words):
            at = index.get("=" + word, -1)
            if at < 0 and len(word) > PREFIXES[0]:
                for length in reversed(PREFIXES):
                    if len(word) > length and (at := index.get(word[:length], -1)) >= 0:
                        break
            found[i] = at
        return found


def choose_entries(rows: list[tuple[str, int, int]], clean: int, toxic: int) -> Lexicon:
    """The entries that tell most about the label; none that only narrows a chosen one down."""

    def told(row: tuple[str, int, int]) -> float:
        _, a, b = row
        p, q = (b + 0.5) / (toxic + 1), (a + 0.5) / (clean + 1)
        mean = (a + b + 1) / (clean + toxic + 2)
        return b * np.log(p / mean) + a * np.log(q / mean)

    chosen: list[str] = []
    for entry, _, _ in sorted(rows, key=lambda r: (-told(r), len(r[0]), r[0])):
        bare = entry.lstrip("=")
        if any(not c.startswith("=") and bare.startswith(c) for c in chosen):
            continue
        chosen.append(entry)
        if len(chosen) == ENTRIES:
            break
    return Lexicon(tuple(chosen))


def hit_counts(text: pa.Array, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hits of each entry in each text, words of each text, hits near the one before."""
    words = split_words(text, lower=False)
    number, width = len(words.counts), max(len(lexicon.entries), 1)
    entry = lexicon.match(_bare(words.words))[words.codes]
    at = np.flatnonzero(entry >= 0)
    texts = np.searchsorted(words.offsets, at, "right") - 1
    counts = np.bincount(texts * width + entry[at], minlength=number * width).reshape(number, width)
    near = np.zeros(len(at), bool)
    near[1:] = (np.diff(at) <= NEAR) & (np.diff(texts) == 0)
    return counts, words.counts, np.bincount(texts, near, number)


def votes(counts: np.ndarray, words: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Which voters speak up on each text: the entries, then the patterns."""
    hits = counts.sum(axis=1)
    dense = (hits > 0) & (hits * 200 >= words)
    patterns = (hits > 0, (counts > 0).sum(axis=1) > 1, hits > 2, near > 0, dense)
    return np.column_stack([counts > 0, *patterns])


def features(counts: np.ndarray, words: np.ndarray, near: np.ndarray) -> np.ndarray:
    hits = counts.sum(axis=1)
    share = hits / np.maximum(words, 1)
    return np.column_stack(
        [np.log1p(counts), votes(counts, words, near)[:, counts.shape[1] :], np.log1p(hits),
         np.log1p(near), np.minimum(share * 100, 20), np.log1p(words)]
    )


def label_model(
    spoke: np.ndarray, given: np.ndarray, prior: float, rounds: int = 40
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the label of each text, rates of each voter by label, and voters' weights.

    ``spoke`` has a column for each voter, ``given`` the label it came with, a voter too.
    """
    x = np.column_stack([spoke, given == 1]).astype(float)
    posterior = np.where(given == 1, 0.9, 0.1)
    weights = np.ones(x.shape[1])
    for turn in range(rounds):
        rates = np.stack(
            [(w @ x + 0.5) / (w.sum() + 1) for w in (1 - posterior, posterior)]
        )
        # nobody knows the label for certain, so no voter may decide alone
        rates = np.clip(rates, 1e-4, 1 - 1e-4)
        rates[:, -1] = np.clip(rates[:, -1], 0.02, 0.98)
        if turn % 10 == 5:
            weights = shared_weights(x, posterior, rates)
        odds = np.log(prior / (1 - prior)) + (
            x @ (weights * np.log(rates[1] / rates[0]))
            + (1 - x) @ (weights * np.log((1 - rates[1]) / (1 - rates[0])))
        )
        posterior = sigmoid(odds)
    return posterior, rates, weights


def shared_weights(x: np.ndarray, posterior: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """One over one plus the correlations a voter has with others within the same label."""
    total = np.zeros((x.shape[1], x.shape[1]))
    for label, w in enumerate((1 - posterior, posterior)):
        rest = (x - rates[label]) * np.sqrt(w)[:, None]
        size = np.sqrt((rest**2).sum(axis=0)) + 1e-9
        total += (rest.T @ rest) / np.outer(size, size) * w.sum() / max(len(w), 1)
    strong = np.where(total > 0.1, total, 0)
    np.fill_diagonal(strong, 0)
    strong[-1] = strong[:, -1] = 0  # the given label shares with nobody
    return 1 / (1 + strong.sum(axis=1))


@dataclass(frozen=True)
class Detector:
    lexicon: Lexicon
    classifier: Logistic

    def score(self, text: pa.Array) -> np.ndarray:
        return sigmoid(self.classifier.logit(features(*hit_counts(text, self.lexicon))))


def _count_hits(lexicon: Lexicon):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            counts, words, near = hit_counts(chunk.column("text"), lexicon)
            rows = np.column_stack([counts, words, near]).astype(np.int64)
            packed = pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), packed, chunk.column("label")],
                ["doc_id", "row", "label"],
            )

    return count


def train(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, size: int = SAMPLE_DOCUMENTS
) -> Detector:
    """Learn from ``labels.toxic`` of at most ``size`` documents of those that ``learn`` allows.

    ``learn`` is a condition on ``doc_id``. Without labels of both kinds nothing tells the two apart
    and every text gets the rate of the labels there are; without any label that is 0.5, which
    counts as toxic.
    """
    sample = labelled_sample(docs, labels, "toxic", size, learn)
    usable = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    usable = usable.filter(learn) if learn is not None else usable
    all_labels = dict(usable.groupBy("toxic").count().collect())
    there = [all_labels.get(0, 0), all_labels.get(1, 0)]
    taken = [min(n, size // 2) for n in there]
    least = max(LEAST_DOCUMENTS, 0.002 * taken[1])
    rates = [(F.col(c) + 0.5) / (n + 1) for c, n in (("toxic", taken[1]), ("clean", taken[0]))]
    rows = (
        map_arrow(sample, _count_entries, "entry string, clean long, toxic long")
        .groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter((F.col("toxic") >= least) & (rates[0] >= LIFT * rates[1]))
        .orderBy(F.desc(F.col("toxic") * F.log(rates[0] / rates[1])), "entry").limit(20 * ENTRIES)
        .collect()
    )
    lexicon = choose_entries([tuple(r) for r in rows], *taken)
    found = (
        map_arrow(sample, _count_hits(lexicon), "doc_id long, row binary, label int")
        .groupBy("doc_id").agg(F.min("row").alias("row"), F.first("label").alias("label"))
        .orderBy("doc_id").collect()
    )
    width = max(len(lexicon.entries), 1) + 2
    table = np.array([np.frombuffer(r["row"], np.int64) for r in found]).reshape(len(found), width)
    given = np.array([r["label"] for r in found], int)
    parts = (table[:, :-2], table[:, -2], table[:, -1])
    prior = min(max(given.mean(), 0.01), 0.99) if len(given) else 0.5
    posterior, _, _ = label_model(votes(*parts), given, prior)
    classifier = Logistic.fit(features(*parts), posterior)
    # the sample has as many of both labels as there are; the odds go back to those of all labels
    rate = min(max((there[1] + 0.5) / (sum(there) + 1), 1e-3), 1 - 1e-3)
    classifier.weights[0] += np.log(rate / (1 - rate)) - np.log(prior / (1 - prior))
    return Detector(lexicon, classifier)


def _score(detector: Detector, names: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            scores = detector.score(chunk.column("text"))
            kept = [chunk.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                [*names, "score", "predicted"],
            )

    return score


def score_documents(
    docs: DataFrame, detector: Detector, keep: tuple[Column, ...], text: str = "text"
) -> DataFrame:
    """``keep``, then ``score`` from 0 to 1 and ``predicted`` of every row of ``docs``.

    Only the text plays a part. A null or empty text has no hits and gets the score of one; equal
    texts score alike; a score of exactly one half is predicted 1.
    """
    kept = docs.select(*keep)
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields)
    rows = docs.select(*keep, F.col(text).alias("text"))
    return map_arrow(rows, _score(detector, kept.columns), types + "score double, predicted int")
