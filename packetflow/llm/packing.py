"""Packing token sequences: the cutting-stock problem, solved by column generation.

Documents are cut into pieces of at most the sequence length; only a document that does not fit is
cut. Lengths are counted in classes of ``GRAIN`` tokens. A linear program over patterns (how many
pieces of each class share a sequence) is solved on that histogram: its prices go into a knapsack
whose best filling is the next pattern, until none pays. The pattern counts are rounded down and
the few pieces left over are placed best-fit. Then the pieces of each class are ranked, and the
ranks are handed to the places of the patterns in order: a join with a plan of bounded size. The
driver sees one number for each class, never a piece.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetflow.llm.common import chunks, map_arrow
from packetflow.session import work_dir

#: Tokens in one unit of the length classes; a piece leaves less than this unused.
GRAIN = 8

#: Pieces of one class that are ranked in one group.
GROUP_PIECES = 100_000

#: How a byte-level tokenizer cuts text before it merges, where white space is at most
#: two characters long and before something else; the mark put before a text, and a white-space
#: character that stands between words that are encoded together.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
FIRST, BETWEEN = "\0", "\x0c"

#: Different words, of at most so many letters, whose ids a worker keeps from chunk to chunk.
KNOWN_WORDS, KNOWN_LETTERS = 200_000, 32

_ENCODERS: dict[str, Encoder] = {}


class Found(NamedTuple):
    """Ids of words: ``flat[begins[i]:begins[i] + sizes[i]]`` are those of word i.

    Where ``whole`` is set, the texts that hold the word have to be encoded as a whole.
    """

    flat: np.ndarray
    begins: np.ndarray
    sizes: np.ndarray
    whole: np.ndarray


def _nothing(count: int = 0) -> Found:
    zeros = np.zeros(count, np.int64)
    return Found(np.zeros(0, np.uint32), zeros, zeros.copy(), np.ones(count, bool))


class Encoder:
    """Ids of whole texts from a tokenizer file; every different word of a chunk is encoded once.

    The first ``KNOWN_WORDS`` short words that a worker meets are kept for later chunks.

    A byte-level tokenizer never joins what a single space followed by no white space parts. So a
    text is cut there, and the ids of its parts are put together. Words of Western letters whose
    merges the file lists in the order of their ids go through a faster merger, all at once and
    without a Python object for each; other words, and whole texts with other white space or special
    tokens, through the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content for t in added if t.content]
        self.merger = self._merger(json.loads(Path(path).read_text(encoding="utf-8")))
        self.known, self.known_ids = pa.array([], pa.string()), _nothing()
        if self.merger:
            self.between = self.merger.encode_ordinary(BETWEEN)

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    @staticmethod
    def _merger(described: dict):
        """The same vocabulary as ranks of byte strings, if it can be one; else None."""
        before, model = described.get("pre_tokenizer") or {}, described["model"]
        plain = (
            model.get("type") == "BPE"
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(model.get(k) for k in _OPTIONS)
            and described.get("normalizer") is None
        )
        if not plain:
            return None
        shown = [b for r in ((33, 126), (161, 172), (174, 255)) for b in range(r[0], r[1] + 1)]
        letters = {chr(b): b for b in shown}
        letters |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
        vocab = model["vocab"]
        merged = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [vocab["".join(pair)] for pair in merged]
        special = {t["content"] for t in described.get("added_tokens", [])}
        if order != sorted(order) or len(order) + 256 != len(set(vocab) - special):
            return None
        import tiktoken

        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
        # words hold no special tokens; with none to look for it would stop at every character
        apart = {t["content"]: t["id"] for t in described.get("added_tokens", []) if t["content"]}
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=apart)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _merged(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of words and how many each has, by the merger; None if they cannot be told apart."""
        spelled = pc.if_else(
            pc.starts_with(units, FIRST),
            pc.utf8_slice_codeunits(units, 1),
            pc.binary_join_element_wise(" ", units, ""),
        )
        together = pc.binary_join(pa.ListArray.from_arrays([0, len(units)], spelled), BETWEEN)
        ids = self.merger.encode_to_numpy(together[0].as_py() + BETWEEN, disallowed_special=())
        parts = ids == self.between[0]
        ends = np.flatnonzero(parts)
        if len(self.between) != 1 or len(ends) != len(units):
            return None
        return ids[~parts], np.diff(ends, prepend=-1) - 1

    def _words(self, units: pa.Array) -> Found:
        """Ids of the parts of texts."""
        result = _nothing(len(units))
        odd = np.zeros(len(units), bool)
        for special in self.special:
            odd |= pc.match_substring(units, special).to_numpy(False)
        fast = np.zeros(len(units), bool)
        if self.merger:
            fast = pc.match_substring_regex(units, _WESTERN).to_numpy(False) & ~odd
            fast &= ~pc.match_substring_regex(units, _LONG_SPACE).to_numpy(False)
        flat = []
        if fast.any():
            merged = self._merged(units.filter(pa.array(fast)))
            if merged:
                ids, sizes = merged
                flat.append(ids)
                result.sizes[fast], result.begins[fast] = sizes, np.cumsum(sizes) - sizes
                result.whole[fast] = False
            else:
                fast[:] = False
        rest = np.flatnonzero(~(fast | odd))
        slow, spelled = [], []
        for i, unit in zip(rest.tolist(), units.take(pa.array(rest)).to_pylist(), strict=True):
            body = unit[1:] if unit[:1] == FIRST else unit
            if unit == FIRST and self.merger:  # of an empty text, or before a space: no ids
                result.whole[i] = False
            elif body and not body[0].isspace() and not body[-1].isspace():
                slow.append(i)
                spelled.append(body if unit[:1] == FIRST else " " + unit)
        used = sum(map(len, flat))
        for begin in range(0, len(slow), 20_000):
            some, found = slow[begin : begin + 20_000], self._plain(spelled[begin : begin + 20_000])
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            result.sizes[some], result.begins[some] = sizes, used + np.cumsum(sizes) - sizes
            result.whole[some] = False
            flat += found
            used += int(sizes.sum())
        return result._replace(flat=np.concatenate(flat)) if flat else result

    def _found(self, units: pa.Array) -> Found:
        """The same as ``_words``, which is asked only for what is not known."""
        held, before = self.known, self.known_ids
        places = pc.fill_null(pc.index_in(units, held), -1).to_numpy(False)
        old, new = np.flatnonzero(places >= 0), np.flatnonzero(places < 0)
        words = units.take(pa.array(new))
        own = self._words(words)
        result = _nothing(len(units))._replace(flat=np.concatenate([before.flat, own.flat]))
        result.whole[old], result.whole[new] = False, own.whole
        result.sizes[old], result.sizes[new] = before.sizes[places[old]], own.sizes
        result.begins[old], result.begins[new] = before.begins[places[old]], own.begins + len(before.flat)
        short = pc.utf8_length(words).to_numpy(False) <= KNOWN_LETTERS
        kept = np.flatnonzero(short & ~own.whole)[: max(0, KNOWN_WORDS - len(held))]
        if len(kept):
            ids = before.flat, own.flat[_spans(own.begins[kept], own.sizes[kept])]
            sizes = np.concatenate([before.sizes, own.sizes[kept]])
            self.known = pa.concat_arrays([held, words.take(pa.array(kept))])
            self.known_ids = Found(
                np.concatenate(ids), np.cumsum(sizes) - sizes, sizes, np.zeros(len(sizes), bool)
            )
        return result

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: none), and where those of each text begin."""
        text = pc.fill_null(text, "")
        parts = pc.split_pattern(pc.binary_join_element_wise(FIRST, text, ""), " ")
        encoded = parts.values.dictionary_encode()
        codes = encoded.indices.to_numpy(False).astype(np.int64)
        bounds = parts.offsets.to_numpy().astype(np.int64)
        found = self._found(encoded.dictionary)
        sums = np.concatenate([[0], np.cumsum(found.whole[codes])])
        marked = pc.match_substring(text, FIRST).to_numpy(False)  # the mark can not be told apart
        odd = np.flatnonzero((np.diff(sums[bounds]) > 0) | marked)
        sizes = found.sizes[codes]
        ids = found.flat[_spans(found.begins[codes], sizes)]
        offsets = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        if len(odd):
            pieces = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            again = self._plain([text[int(i)].as_py() for i in odd])
            for i, own in zip(odd.tolist(), again, strict=True):
                pieces[i] = own
            ids = np.concatenate(pieces)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in pieces])])
        return ids, offsets


def _spans(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one span after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


#: What would change how a tokenizer merges.
_OPTIONS = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")

#: Letters on whose kind all Unicode tables agree, neither mark, separator nor white space at the
#: ends of a word; words of other ones, or with longer white space inside, go to the tokenizer itself.
_WESTERN = (
    r"\A\x00?[\x01-\x08\x0e-\x1b\x21-\x{84}\x{86}-\x{9f}\x{a1}-\x{24f}]"
    r"(?:[\x01-\x0b\x0d-\x{24f}]*[\x01-\x08\x0e-\x1b\x21-\x{84}\x{86}-\x{9f}\x{a1}-\x{24f}])?\z"
)
_LONG_SPACE = r"[\t\n\x0b\r\x{85}\x{a0}]{3}"


def _pieces(path: str, size: int, end: int, text: str, names: list[str], with_ids: bool):
    last = np.array([end], np.uint32).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = Encoder.of(path), 0
        for chunk in chunks(batches, column=text):
            ids, offsets = encoder.encode(chunk.column(text))
            names_of = ("start", "length", "ids_crc32", "doc_tokens", "spot")
            rows, columns = [], {c: [] for c in names_of}
            packed = []
            for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                own = ids[a:b].tobytes() + last
                total = len(own) // 4
                for start in range(0, total, size):
                    piece = own[4 * start : 4 * (start + size)]
                    rows.append(row)
                    columns["start"].append(start)
                    columns["length"].append(len(piece) // 4)
                    columns["ids_crc32"].append(zlib.crc32(piece))
                    columns["doc_tokens"].append(total)
                    columns["spot"].append(number)
                    number += 1
                    if with_ids:
                        packed.append(np.frombuffer(piece, np.uint32).astype(np.int32))
            kept = chunk.select(names).take(pa.array(rows, pa.int64())) if names else None
            arrays = kept.columns if kept else []
            arrays = arrays + [pa.array(v, pa.int64()) for v in columns.values()]
            labels = names + list(columns)
            if with_ids:
                arrays.append(pa.array(packed, pa.list_(pa.int32())))
                labels.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, labels)

    return cut


def pieces(
    docs: DataFrame, tokenizer: str, size: int = 2048, end: int = 1, text: str = "text",
    doc_id: str = "doc_id", with_ids: bool = False,
) -> DataFrame:
    """Every document as ids, ``end`` after the last, cut into pieces of at most ``size`` ids.

    A null text is an empty one: a single piece of the id ``end``. ``spot`` numbers the pieces of a
    task. ``with_ids`` adds the ids themselves.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, spot long"
    schema += ", ids array<int>" if with_ids else ""
    return map_arrow(rows, _pieces(tokenizer, size, end, "text", ["doc_id"], with_ids), schema)


def _best_filling(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The knapsack: which numbers of pieces fill the capacity at the highest price."""
    worth, chosen = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        worth[room] = worth[room - 1]
        fits = int(np.searchsorted(sizes, room, "right"))
        if fits:
            values = worth[room - sizes[:fits]] + prices[:fits]
            best = int(np.argmax(values))
            if values[best] > worth[room] + 1e-12:
                worth[room], chosen[room] = values[best], best
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if chosen[room] < 0:
            room -= 1
        else:
            pattern[chosen[room]] += 1
            room -= sizes[chosen[room]]
    return float(worth[capacity]), pattern


def patterns(histogram: Mapping[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (pieces of each class) and how often to use each; together exactly the histogram."""
    classes = sorted(k for k, n in histogram.items() if n > 0 and k < capacity)
    used: Counter[tuple] = Counter()
    if full := histogram.get(capacity, 0):
        used[((capacity, 1),)] += full
    if classes:
        sizes = np.array(classes)
        demand = np.array([histogram[k] for k in classes], float)
        columns = np.diag(capacity // sizes).astype(float)
        inverse = np.diag(1 / columns.diagonal())
        amounts = inverse @ demand
        for _ in range(20 * len(classes) + 200):
            worth, pattern = _best_filling(sizes, inverse.sum(axis=0), capacity)
            if worth <= 1 + 1e-7:
                break
            step = inverse @ pattern
            able = step > 1e-9
            ratios = np.full(len(step), np.inf)
            ratios[able] = amounts[able] / step[able]
            leaving = int(np.argmin(ratios))
            pivot = inverse[leaving] / step[leaving]
            inverse -= np.outer(step, pivot)
            inverse[leaving] = pivot
            amounts -= step * ratios[leaving]
            amounts[leaving] = ratios[leaving]
            columns[:, leaving] = pattern
        times = np.floor(np.maximum(amounts, 0) + 1e-6)
        left = demand - columns @ times
        while (left < -0.5).any():  # rounding noise took one too many
            times[np.argmax(times * (columns[int(np.argmin(left))] > 0))] -= 1
            left = demand - columns @ times
        for j in np.flatnonzero(times > 0):
            key = tuple((classes[i], int(columns[i, j])) for i in np.flatnonzero(columns[:, j]))
            used[key] += int(times[j])
        rest = {k: round(n) for k, n in zip(classes, left, strict=True)}
        for pattern in _best_fit(rest, capacity):
            used[pattern] += 1
    return [(dict(pattern), times) for pattern, times in sorted(used.items())]


def _best_fit(left: Mapping[int, int], capacity: int) -> Iterator[tuple]:
    """Place pieces, longest first, where the least room remains."""
    open_bins: dict[int, list[Counter]] = {}
    for size in sorted(left, reverse=True):
        for _ in range(left[size]):
            room = next((r for r in range(size, capacity) if open_bins.get(r)), None)
            held = open_bins[room].pop() if room is not None else Counter()
            room = capacity if room is None else room
            held[size] += 1
            open_bins.setdefault(room - size, []).append(held)
    for bins in open_bins.values():
        for held in bins:
            yield tuple(sorted(held.items()))


def places(found: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(class, first rank, end of ranks, pieces in a sequence, first sequence)`` of each place."""
    ranks: Counter[int] = Counter()
    rows, sequence = [], 0
    for pattern, times in found:
        for size, copies in pattern.items():
            rows.append((size, ranks[size], ranks[size] + times * copies, copies, sequence))
            ranks[size] += times * copies
        sequence += times
    return rows


def assign(cut: DataFrame, size: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have ``length`` and ``spot``.

    ``cut`` has to be a written table: it is read for the histogram, the ranks and the result. No
    piece is cut further, and no group of rows is larger than ``GROUP_PIECES`` or one sequence.
    """
    spark = cut.sparkSession
    grain = GRAIN if size % GRAIN == 0 else 1
    sized = cut.withColumn("__class", F.ceil(F.col("length") / grain).cast("int"))
    total = sized.count()
    spread = F.pmod(F.col("spot"), F.lit(max(1, total // GROUP_PIECES))).cast("int")
    sized = sized.withColumn("__spread", spread)
    counts = sized.groupBy("__class", "__spread").agg(F.count("*").alias("__n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("__class").agg(F.sum("__n")).collect()}
    plan = spark.createDataFrame(
        places(patterns(histogram, size // grain)),
        "__class int, __from long, __to long, __each long, __first long",
    )
    groups = ["__class", "__spread"]
    earlier = (Window.unboundedPreceding, -1)
    before = Window.partitionBy("__class").orderBy("__spread").rowsBetween(*earlier)
    begin = F.coalesce(F.sum("__n").over(before), F.lit(0))
    begins = counts.select(*groups, begin.alias("__begin"))
    within = Window.partitionBy(*groups).orderBy("doc_id", "start", "ids_crc32", "spot")
    ranked = (
        sized.withColumn("__row", F.row_number().over(within) - 1)
        .join(begins, groups)
        .withColumn("__rank", F.col("__row") + F.col("__begin"))
    )
    inside = (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to"))
    placed = ranked.alias("r").join(
        F.broadcast(plan.alias("p")), (F.col("r.__class") == F.col("p.__class")) & inside
    )
    sequence = F.col("__first") + F.floor((F.col("__rank") - F.col("__from")) / F.col("__each"))
    ahead = (
        Window.partitionBy("sequence_id").orderBy(F.desc("length"), "__rank")
        .rowsBetween(*earlier)
    )
    kept = [F.col(f"r.{c}").alias(c) for c in cut.columns if c != "spot"]
    return (
        placed.withColumn("sequence_id", sequence)
        .withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)))
        .select(*kept, "sequence_id", "offset")
    )


def pack(
    docs: DataFrame, tokenizer: str, size: int = 2048, end: int = 1, text: str = "text",
    doc_id: str = "doc_id", with_ids: bool = False,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, [ids,] sequence_id, offset`` of every piece.

    Sequences hold at most ``size`` ids, gapless from offset 0. Rows that repeat an id are packed
    each; a null id stays null; an empty or null text is one piece of the id ``end``; no rows give
    no pieces. Columns of other names play no part. The pieces are written once to the shared
    folder, since their lengths decide where each goes.
    """
    cut = pieces(docs, tokenizer, size, end, text, doc_id, with_ids)
    path = f"{work_dir(docs.sparkSession, 'packing')}/pieces"
    cut.write.parquet(path)
    return assign(docs.sparkSession.read.schema(cut.schema).parquet(path), size)
