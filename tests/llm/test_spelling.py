import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from packetflow.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RESULT = ["word", "form", "root", "n", "n_near", "form_n"]


def plain_counts(docs, least_length, least_count, edits):
    counts = Counter()
    for doc_id, text in docs:
        for run, n in Counter(RUN.findall((text or "").translate(LOWER))).items():
            digest = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if edits and digest % edits == 0:
                run = run[: digest % len(run)] + run[digest % len(run) + 1 :]
            counts[run] += n
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    form, near = {}, defaultdict(list)
    for word in counts:
        near[word] = [other for other in counts if other != word and one_edit(word, other)]
        if near[word]:
            best = min(near[word], key=lambda w: (-counts[w], w))
            if counts[best] >= 2 * counts[word]:
                form[word] = best

    def root(word):
        return root(form[word]) if word in form else word

    return {
        (w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None)
        for w, n in counts.items()
    }


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abéz"), rng.integers(4, 8))) for _ in range(60)]
    return [
        (i, " ".join(rng.choice(words, rng.integers(0, 60))).replace("z", "Z-", 1))
        for i in range(120)
    ]


@pytest.mark.parametrize("block_words", [4096, 3])
def test_variants_equal_plain_code(spark, texts, block_words):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    counts = spelling.word_counts(docs, edits=5)
    found = spelling.variants(counts, block_words=block_words).select(RESULT).collect()
    expected = plain_counts(texts, 5, 3, 5)
    assert len(found) == len(expected) > 50
    assert {tuple(r) for r in found} == plain_variants(expected)


def test_nulls_long_runs_repeats_and_other_columns(spark):
    long = "x" * 70_000
    rows = [
        (None, f"{long} abcde", 1), (None, None, 2), (1, "", 3), (2, f"{long} {long}", 4),
        (2, f"ABCDE abcdé {long[:-1]}× 12 Ābcde", 5), (2, "abcde abcde", 6),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word int")
    found = {r.word: r for r in spelling.variants(spelling.word_counts(docs, least_count=1)).collect()}
    assert set(found) == {long, "abcde", "abcdé", long[:-1] + "×"}
    assert (found[long].n, found[long].n_near) == (3, 1)
    assert found["abcdé"].form == found["abcdé"].root == "abcde"
    assert found["abcde"].form is None and found["abcde"].n == 4


def test_no_words(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.word_counts(docs)).collect() == []


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)]
    found = spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r.root for r in found} == {"w37"} and len(found) == 37


def test_hashes_of_pairs_are_those_of_the_joined_text():
    heads, tails = [b"", b"17:", b"x" * 9], [b"", b"a", b"caf\xc3\xa9", b"y" * 64]
    a, b = (np.array([zlib.crc32(x) for x in side], np.uint32) for side in (heads, tails))
    at, of = (x.ravel() for x in np.meshgrid(range(3), range(4)))
    got = spelling.pair_crc32(a[at], b[of], np.array([len(tails[i]) for i in of]))
    assert got.tolist() == [zlib.crc32(heads[i] + tails[j]) for i, j in zip(at, of, strict=True)]


def test_runs_of_slices():
    texts = pa.array(["no", "Àb-C× Ād", None, "", "ÿ1Z"]).slice(1)
    found = spelling.letter_runs(texts)
    words = [found.words[int(c)].as_py() for c in found.codes]
    assert words == ["Àb", "c×", "d", "ÿ", "z"]
    assert found.offsets.tolist() == [0, 3, 3, 3, 5]
