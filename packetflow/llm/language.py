"""Language of mixed text: script ranges, scores per word, Viterbi over the words.

A word's script leaves the languages that are written in it. Each of these scores the word by the
log probability of its byte trigrams, learned from labelled texts. A path through the words of a
text pays a penalty for every change of language; the best one labels spans, and the language with
the most letters under its spans is that of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetflow.llm.common import chunks, map_arrow, split_words
from packetflow.llm.shapes import string_bytes

#: Labelled texts of each language that are learned from, on average (chosen by hash).
SAMPLE_DOCUMENTS = 4000

#: Slots of trigram counts; the model is this many numbers for each language.
SLOTS = 1 << 16

#: Most languages: the model then takes 52 MB.
LANGUAGES = 200

#: Log probability that a change of language costs.
SWITCH = 6.0

#: Share of a language's words in a script from which on it is written in it.
IN_SCRIPT = 0.01

CHUNK_BYTES = 12 << 20

#: First and last code point of ranges, and the script they belong to.
SCRIPTS = (
    (0x41, 0x5A, "Latin"), (0x61, 0x7A, "Latin"), (0xAA, 0xAA, "Latin"), (0xBA, 0xBA, "Latin"),
    (0xC0, 0xD6, "Latin"), (0xD8, 0xF6, "Latin"), (0xF8, 0x2AF, "Latin"), (0x370, 0x3FF, "Greek"),
    (0x400, 0x52F, "Cyrillic"), (0x531, 0x58F, "Armenian"), (0x591, 0x5FF, "Hebrew"),
    (0x600, 0x6FF, "Arabic"), (0x750, 0x77F, "Arabic"), (0x900, 0x97F, "Devanagari"),
    (0x980, 0x9FF, "Bengali"), (0xA00, 0xA7F, "Gurmukhi"), (0xA80, 0xAFF, "Gujarati"),
    (0xB80, 0xBFF, "Tamil"), (0xC00, 0xC7F, "Telugu"), (0xC80, 0xCFF, "Kannada"),
    (0xD00, 0xD7F, "Malayalam"), (0xE00, 0xE7F, "Thai"), (0x10A0, 0x10FF, "Georgian"),
    (0x1100, 0x11FF, "Hangul"), (0x1E00, 0x1EFF, "Latin"), (0x1F00, 0x1FFF, "Greek"),
    (0x3040, 0x309F, "Kana"), (0x30A0, 0x30FF, "Kana"), (0x3400, 0x4DBF, "Han"),
    (0x4E00, 0x9FFF, "Han"), (0xAC00, 0xD7AF, "Hangul"),
)
NAMES = ("other", *dict.fromkeys(name for _, _, name in SCRIPTS))
_STARTS = np.array([first for first, _, _ in SCRIPTS])
_ENDS = np.array([last for _, last, _ in SCRIPTS])
_OF_RANGE = np.array([NAMES.index(name) for _, _, name in SCRIPTS])
_NO_LETTERS = r"[^\pL\pM]+"


class Tokens(NamedTuple):
    """Words of letters: the number of each in the texts, where texts begin, the words."""

    codes: np.ndarray
    offsets: np.ndarray
    words: pa.Array


def letter_words(text: pa.Array) -> Tokens:
    """Words between white space in lower case, without what is no letter; those without are out."""
    found = split_words(text, lower=False)
    bare = pc.replace_substring_regex(pc.utf8_lower(found.words), _NO_LETTERS, "")
    full = pc.not_equal(bare, "").to_numpy(False)
    keep = full[found.codes]
    return Tokens(found.codes[keep], np.concatenate([[0], np.cumsum(keep)])[found.offsets], bare)


def scripts_of(words: pa.Array) -> np.ndarray:
    """The script of each word's first letter."""
    first = pc.utf8_slice_codeunits(words, 0, 1).to_pylist()
    points = np.fromiter((ord(c) if c else 0 for c in first), np.int64, len(first))
    place = np.searchsorted(_STARTS, points, "right") - 1
    inside = (place >= 0) & (points <= _ENDS[place])
    return np.where(inside, _OF_RANGE[place], 0)


def trigrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the byte trigrams of each word with its ends, and the word each is of."""
    # one space before and after: as many trigrams as bytes
    padded = pc.binary_join_element_wise(" ", words, " ", "")
    flat, offsets = string_bytes(padded)
    sizes = np.diff(offsets)
    number = np.repeat(np.arange(len(sizes)), np.maximum(sizes - 2, 0))
    at = np.arange(len(number)) + 2 * number  # every word before leaves two out
    a, b, c = (flat[at + i].astype(np.uint32) for i in range(3))
    mixed = (a * np.uint32(65599) + b) * np.uint32(65599) + c
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return (mixed >> np.uint32(16)).astype(np.int64) % SLOTS, number


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches):
        found = letter_words(chunk.column("text"))
        if not len(found.codes):
            continue
        slots, number = trigrams(found.words)
        scripts = scripts_of(found.words)
        langs = chunk.column("lang").to_pylist()
        of_token = np.repeat(np.arange(len(langs)), np.diff(found.offsets))
        for lang in dict.fromkeys(langs):
            own = np.fromiter((x == lang for x in langs), bool, len(langs))
            times = np.bincount(found.codes[own[of_token]], minlength=len(found.words))
            counts = np.bincount(slots, times[number], SLOTS)
            seen = np.flatnonzero(counts)
            written = np.bincount(scripts, times, len(NAMES))
            slot = np.concatenate([seen, -1 - np.flatnonzero(written)])
            n = np.concatenate([counts[seen], written[written > 0]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slot), pa.string()), pa.array(slot, pa.int64()), pa.array(n)],
                ["lang", "slot", "n"],
            )


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    logs: np.ndarray  # of each slot and language
    allowed: np.ndarray  # of each script and language


def train(
    docs: DataFrame, lang: str = "lang", text: str = "text", size: int = SAMPLE_DOCUMENTS
) -> Model:
    """Learn from rows with a language: of each language about ``size``, all if there are fewer.

    Which ones does not depend on the order of rows: a hash of the id decides. Counts are summed in
    Spark; the driver gets ``SLOTS`` numbers for each language.
    """
    rows = docs.select("doc_id", F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    counted = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang")
    there = counted.limit(LANGUAGES + 1).collect()
    if len(there) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages: the column does not name languages")
    if not there:
        return Model((), np.zeros((SLOTS, 0), np.float32), np.zeros((len(NAMES), 0), bool))
    parts = F.create_map(
        *[F.lit(x) for r in there for x in (r["lang"], min(1.0, size / r["count"]))]
    )
    draw = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1_000_000)) / 1_000_000
    sample = rows.filter(draw < parts[F.col("lang")]).select("lang", "text")
    counts = (
        map_arrow(sample, _count, "lang string, slot long, n long")
        .groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    )
    languages = tuple(sorted(r["lang"] for r in there))
    number = F.create_map(*[F.lit(x) for i, name in enumerate(languages) for x in (name, i)])
    table = counts.select(number[F.col("lang")].alias("column"), "slot", "n").toPandas()
    column = table["column"].to_numpy(np.int64)
    slot, n = table["slot"].to_numpy(np.int64), table["n"].to_numpy(np.float64)
    tally = np.full((SLOTS, len(languages)), 0.1)
    written = np.zeros((len(NAMES), len(languages)))
    np.add.at(tally, (slot[slot >= 0], column[slot >= 0]), n[slot >= 0])
    np.add.at(written, (-1 - slot[slot < 0], column[slot < 0]), n[slot < 0])
    logs = np.log(tally / tally.sum(axis=0)).astype(np.float32)
    return Model(languages, logs, written >= np.maximum(IN_SCRIPT * written.sum(axis=0), 1))


#: What a language pays for a word in a script that it is not written in.
FOREIGN = 50.0


def word_scores(words: pa.Array, model: Model) -> np.ndarray:
    """Log score of each word in each language, against the best one."""
    slots, number = trigrams(words)
    scores = np.zeros((len(words), len(model.languages)), np.float32)
    bounds = np.searchsorted(number, np.arange(len(words)))
    filled = np.flatnonzero(np.diff(np.concatenate([bounds, [len(number)]])) > 0)
    if len(filled):
        scores[filled] = np.add.reduceat(model.logs[slots], bounds[filled], axis=0)
    allowed = model.allowed[scripts_of(words)]
    # a script that nobody was seen to write leaves all languages
    scores -= np.where(allowed | ~allowed.any(axis=1, keepdims=True), 0, FOREIGN).astype(np.float32)
    return scores - scores.max(axis=1, keepdims=True, initial=-np.inf)


def best_paths(
    codes: np.ndarray, offsets: np.ndarray, scores: np.ndarray, switch: float
) -> np.ndarray:
    """The language of each word on the best path of its text; texts go side by side.

    Of languages that are equally good the one of lower number is taken.
    """
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    lengths, begins = lengths[order], offsets[:-1][order]
    longest = int(lengths.max(initial=0))
    active = np.searchsorted(-lengths, -np.arange(1, longest + 1), "right")
    labels = np.zeros(len(codes), np.int16)
    width = scores.shape[1]
    value = np.zeros((len(lengths), width), np.float32)
    stay: list[np.ndarray] = []
    leader: list[np.ndarray] = []
    for t, n in enumerate(active):
        now = value[:n]
        best = now.argmax(axis=1)
        floor = now[np.arange(n), best] - np.float32(switch)
        stay.append(now >= floor[:, None])
        leader.append(best.astype(np.int16))
        np.maximum(now, floor[:, None], out=now)
        now += scores[codes[begins[:n] + t]]
        now -= now.max(axis=1, keepdims=True)  # numbers stay small however long the text
    state = value.argmax(axis=1) if width else np.zeros(len(lengths), np.int64)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        labels[begins[:n] + t] = state[:n]
        kept = stay[t][np.arange(n), state[:n]]
        state[:n] = np.where(kept, state[:n], leader[t])
    return labels


def label_texts(
    text: pa.Array, model: Model, switch: float
) -> tuple[np.ndarray, np.ndarray, Tokens, np.ndarray]:
    """Number of the language of each text (-1: none), its share, the words and their labels."""
    found = letter_words(text)
    rows, width = len(found.offsets) - 1, len(model.languages)
    if not width or not len(found.codes):
        return np.full(rows, -1), np.zeros(rows), found, np.zeros(len(found.codes), np.int16)
    labels = best_paths(found.codes, found.offsets, word_scores(found.words, model), switch)
    letters = pc.utf8_length(found.words).to_numpy(False)[found.codes]
    number = np.repeat(np.arange(rows), np.diff(found.offsets))
    share = np.bincount(number * width + labels, letters, rows * width).reshape(rows, width)
    total = share.sum(axis=1)
    best = np.where(total > 0, share.argmax(axis=1), -1)
    return best, share.max(axis=1) / np.maximum(total, 1), found, labels


def _predict(model: Model, switch: float, names: list[str], spans: bool):
    languages = np.array([*model.languages, "und"], object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, limit=CHUNK_BYTES):
            best, share, found, labels = label_texts(chunk.column("text"), model, switch)
            columns = [pa.array(languages[best], pa.string()), pa.array(share.astype(np.float64))]
            if spans:
                rows = []
                for a, b in zip(found.offsets[:-1], found.offsets[1:], strict=True):
                    cuts = [a, *(np.flatnonzero(np.diff(labels[a:b])) + 1 + a), b] if b > a else []
                    rows.append(
                        [{"start": int(i - a), "end": int(j - a), "lang": languages[labels[i]]}
                         for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                    )
                kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
                columns.append(pa.array(rows, pa.list_(kind)))
            kept = [chunk.column(i) for i in range(len(names))]
            labels_of = [*names, "lang_pred", "score", *(["spans"] if spans else [])]
            yield pa.RecordBatch.from_arrays(kept + columns, labels_of)

    return predict


def predict(
    docs: DataFrame, model: Model, keep: tuple[Column, ...], text: str = "text",
    switch: float = SWITCH, spans: bool = False,
) -> DataFrame:
    """``keep``, then ``lang_pred``, ``score`` and, if asked for, ``spans`` of every row.

    ``score`` is the share of the text's letters in spans of the predicted language. A text that is
    null or has no letter is ``und`` with score 0; so is every text if nothing was learned. Equal
    shares go to the language of lower name. Spans count words of letters from 0. Rows that repeat
    are labelled each. Only the text plays a part.
    """
    kept = docs.select(*keep)
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields)
    schema = types + "lang_pred string, score double"
    schema += ", spans array<struct<start: bigint, end: bigint, lang: string>>" if spans else ""
    rows = docs.select(*keep, F.col(text).alias("text"))
    return map_arrow(rows, _predict(model, switch, kept.columns, spans), schema)
