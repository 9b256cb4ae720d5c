import os
import struct

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from packetflow.llm import packing, queries, token_files

ROWS = [
    (5, "five five", "b"), (3, None, "a"), (None, "no id", "a"), (9, "", "c"), (4, "x " * 9000, "d"),
    (5, "a second text of five", "a"), (7, "seven <|endoftext|> seven\n\n café", "z"),
    (5, "five five", "b"),
]


def encoded(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tokens") / "out")
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, start string")
    token_files.write_tokens(
        docs, folder, queries.tokenizer_path(), end=2, frame_ids=1000, files=3
    )
    return folder


def test_files_give_back_every_document_in_order(spark, written):
    import zlib

    got = token_files.read_digests(spark, written).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 3, 4, 5, 5, 5, 7, 9]
    start, texts = 0, {i: [t for j, t, _ in ROWS if j == i] for i, _, _ in ROWS}
    for row in got:
        sums = {zlib.crc32(np.array(encoded(t), "<u4").tobytes()) for t in texts[row.doc_id]}
        assert row.ids_crc32 in sums and row.start == start
        start += row.n_tokens
    assert start == sum(len(encoded(t)) for _, t, _ in ROWS)


def test_documents_by_number(spark, written):
    got = token_files.read_documents(spark, written, [4, 9, 5, 100]).orderBy("start").collect()
    assert [r.doc_id for r in got] == [4, 5, 5, 5, 9]
    assert got[0].ids == encoded("x " * 9000) and got[-1].ids == [2]
    assert sorted(r.ids for r in got[1:4]) == sorted(encoded(t) for i, t, _ in ROWS if i == 5)


def test_only_the_frames_asked_for_are_read(tmp_path):
    path = tmp_path / "ids"
    with pa.OSFile(str(path), "wb") as sink:
        writer = token_files.TokenWriter(sink, 4, frame_ids=100)
        writer.append(np.arange(950))
        writer.append(np.arange(50))
        writer.close(pa.table({"doc_id": [1, 2], "n_tokens": [950, 50]}))
    raw = path.read_bytes()
    plain = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(raw)
    assert np.frombuffer(plain, "<u4").tolist() == [*range(950), *range(50)]
    assert struct.unpack("<I", raw[-4:]) == (0x8F92EAB1,)
    with pa.OSFile(str(path), "rb") as source:
        reader = token_files.TokenReader(source)
        assert reader.holding(250, 300) == range(2, 3) and reader.holding(99, 101) == range(0, 2)
        assert reader.frame(4).tolist() == list(range(400, 500))
        frame = reader.frames[4]
    broken = bytearray(raw)
    broken[frame.offset + frame.stored // 2] ^= 255
    path.write_bytes(broken)
    with pa.OSFile(str(path), "rb") as source:
        reader = token_files.TokenReader(source)
        reader.frame(3)
        with pytest.raises((ValueError, zstandard.ZstdError)):
            reader.frame(4)


def test_empty_table_and_left_over_files(spark, tmp_path):
    folder = str(tmp_path / "none")
    docs = spark.createDataFrame([], "doc_id long, text string")
    token_files.write_tokens(docs, folder, queries.tokenizer_path(), end=2)
    assert token_files.read_digests(spark, folder).collect() == []
    # a lost attempt leaves a file that no row names
    with open(os.path.join(folder, "ids", "part-0000000-lost.zst"), "wb") as file:
        file.write(b"half a frame")
    assert token_files.read_digests(spark, folder).collect() == []
    assert token_files.read_documents(spark, folder, [1]).collect() == []


def test_starts_over_many_groups_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "GROUP_FILES", 3)
    rows = spark.range(11).select(
        F.col("id").alias("part"), F.lit("f").alias("file"), F.lit(1).cast("long").alias("documents"),
        (F.col("id") + 1).alias("n_ids"),
    )
    rows.write.parquet(str(tmp_path / "files"))
    got = token_files.read_files(spark, str(tmp_path)).orderBy("part").collect()
    assert [r.start for r in got] == [sum(range(1, i + 1)) for i in range(11)]


def test_words_kept_from_chunk_to_chunk_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 3)
    encoder = packing.Encoder(queries.tokenizer_path())
    for texts in (["the cat sat", " on", ""], ["", ""], ["the  cat\n", "cat on the mat", ""]):
        ids, offsets = encoder.encode(pa.array(texts))
        for text, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
            assert ids[a:b].tolist() == encoded(text)[:-1]
