"""Counts of letters, signs, words and lines of many texts at once."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from packetflow.llm.common import runs, split_words, window_hashes, window_starts

#: What a byte of UTF-8 can be; a byte may be in several classes.
CLASSES = ("space", "point", "upper", "digit", "symbol", "bar", "shout")
#: The characters that the counts name.
SYMBOLS = b"#*$%&|<>"
BARS = b"|"
SHOUTS = b"!"


def _byte_classes() -> np.ndarray:
    table = np.zeros((len(CLASSES), 256), np.int32)
    codes = np.arange(256)
    table[0, [9, 10, 11, 12, 13, 32]] = 1
    table[1] = (codes & 0xC0) != 0x80  # the first byte of a code point
    table[2, ord("A") : ord("Z") + 1] = 1
    table[3, ord("0") : ord("9") + 1] = 1
    for row, characters in ((4, SYMBOLS), (5, BARS), (6, SHOUTS)):
        table[row, list(characters)] = 1
    return table


_TABLE = _byte_classes()


def string_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings and where each begins; no nulls may be left."""
    wide = pa.types.is_large_string(text.type)
    offsets = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = text.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def class_counts(flat: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """How many bytes of each class stand between two offsets, and how many words begin there."""
    result = {}
    for name, row in zip(CLASSES, _TABLE, strict=True):
        sums = np.concatenate([[0], np.cumsum(row[flat])])
        result[name] = np.diff(sums[offsets])
    blank = _TABLE[0][flat].astype(bool)
    begins = ~blank
    begins[1:] &= blank[:-1]
    inner = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[inner] = ~blank[inner]
    result["words"] = np.diff(np.concatenate([[0], np.cumsum(begins)])[offsets])
    return result


class Lines(NamedTuple):
    """The \\n-split lines of several texts: counts of each, the text each is in, and repeats."""

    counts: dict[str, np.ndarray]
    texts: np.ndarray
    repeats: np.ndarray  # has a word and equals an earlier line of its text


def split_lines(text: pa.Array) -> Lines:
    parts = pc.split_pattern(text, "\n")
    lines = parts.values
    offsets = parts.offsets.to_numpy().astype(np.int64)
    texts = np.repeat(np.arange(len(text)), np.diff(offsets))
    counts = class_counts(*string_bytes(lines))
    codes = lines.dictionary_encode().indices.to_numpy(False).astype(np.int64)
    key = texts * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    later = np.zeros(len(key), bool)
    later[order[1:]] = key[order[1:]] == key[order[:-1]]
    return Lines(counts, texts, later & (counts["words"] > 0))


def repeated_words(text: pa.Array, width: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and those in windows of ``width`` words found twice or more in it."""
    words = split_words(text, lower=False)
    starts, texts = window_starts(words, width)
    # codes are unique for words: a window of codes is a window of words
    windows = window_hashes(words.codes.astype(np.uint64) + np.uint64(1), starts, width)
    covered = np.zeros(len(words.codes) + 1, bool)
    keys = windows ^ (texts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    bounds = runs(keys[order])
    sizes = np.diff(bounds)
    twice = order[np.repeat(sizes > 1, sizes)]
    for i in range(width):
        covered[starts[twice] + i] = True
    sums = np.concatenate([[0], np.cumsum(covered[:-1])])
    return words.counts, np.diff(sums[words.offsets])


def per_text(values: np.ndarray, texts: np.ndarray, number: int) -> np.ndarray:
    return np.bincount(texts, values, number).astype(np.int64)

