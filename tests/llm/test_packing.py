import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from packetflow.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(PATH)


def plain_ids(text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def ids_of(texts):
    ids, offsets = packing.Encoder.of(PATH).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\0\x0c\x85\u00a0ab'stre9.,éß中😀 ̀²Ⅳ", max_size=30), max_size=4))
def test_ids_by_word_are_those_of_the_tokenizer(texts):
    assert ids_of(texts) == [plain_ids(t) for t in texts]


def test_special_tokens_in_a_text_and_nulls():
    texts = ["a <|endoftext|> b<|endoftext|>", None, "", " ", "x"]
    assert ids_of(texts) == [plain_ids(t) for t in texts]


def test_ids_of_the_table(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    assert packing.Encoder.of(PATH).merger is not None
    assert ids_of(texts) == [plain_ids(t) for t in texts]


def test_white_space_inside_words():
    spaces = ["\n", "\n\n", "\n\n\n", "\t\n\t\n", "\x85\xa0", "\r\n\r", "\x0b\x0b", "\x1c\n\x1d", " \n"]
    texts = [f"{a}the{s}cat's{s}9{b}" for s in spaces for a in ("", " ", "x ") for b in ("", s, " on")]
    assert ids_of(texts) == [plain_ids(t) for t in texts]
    assert ids_of([" a", "", " a b", "  a", " "]) == [plain_ids(t) for t in [" a", "", " a b", "  a", " "]]


def test_words_are_looked_up_and_merged_without_python_calls_for_each():
    encoder = packing.Encoder(PATH)
    texts = [" ".join(f"w{i * 7919 + j}a'n{j}." for j in range(500)) for i in range(40)]
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        ids, offsets = encoder.encode(pa.array(texts))
    finally:
        sys.setprofile(None)
    assert len(calls) < 2_000  # for 20,000 different words
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [plain_ids(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(0, 40), max_size=16))
def test_patterns_cover_the_histogram_exactly(histogram):
    found = packing.patterns(histogram, 16)
    total = {}
    for pattern, times in found:
        assert sum(k * n for k, n in pattern.items()) <= 16
        for k, n in pattern.items():
            total[k] = total.get(k, 0) + n * times
    assert total == {k: n for k, n in histogram.items() if n}
    places = packing.places(found)
    for size, number in total.items():
        ends = sorted((a, b) for k, a, b, _, _ in places if k == size)
        assert [a for a, _ in ends] == [0, *(b for _, b in ends[:-1])] and ends[-1][1] == number


def test_column_generation_is_near_the_bound():
    rng = random.Random(1)
    histogram = {k: rng.randrange(200) for k in range(1, 129)}
    used = sum(times for _, times in packing.patterns(histogram, 256))
    bound = -(-sum(k * n for k, n in histogram.items()) // 256)
    assert used <= 1.01 * bound + 3


def check(rows, texts, size, end=1):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for key, text in texts.items():
        ids = np.array([*plain_ids(text), end], np.uint32)
        at = 0
        for r in sorted(by_doc.pop(key), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert not by_doc
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size


def test_every_id_lies_in_one_piece(spark):
    rng = random.Random(2)
    texts = {i: " ".join(rng.choice(["the", "of", "ble,", "ñé"]) for _ in range(rng.randrange(90))) for i in range(200)}
    texts |= {900: None, 901: "", 902: "x " * 3000}
    rows = [(k, v, "x", 7) for k, v in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, length int")
    check(packing.pack(docs, PATH, size=64).collect(), texts, 64)


def test_repeated_rows_and_null_ids_are_packed_each(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 3 + [(None, "a b c")] * 2, "doc_id long, text string")
    rows = packing.pack(docs, PATH, size=16).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "1", "None", "None"]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 5


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs, PATH).collect() == []
