import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from packetflow.llm import ngram_lm
from packetflow.llm.common import id_remainder


def sentence_tokens(text):
    return [*(text or "").encode().lower().split(), "end"]


class Plain:
    """The model in plain dictionaries."""

    def __init__(self, texts):
        pairs = Counter()
        self.count = Counter()
        for text in texts:
            seen = ["begin", *sentence_tokens(text)]
            pairs.update(zip(seen, seen[1:], strict=False))
            self.count.update(seen[1:])
        self.pairs = pairs
        self.before = Counter(w for _, w in pairs)
        self.total, self.kinds = Counter(), defaultdict(Counter)
        for (h, _), c in pairs.items():
            self.total[h] += c
            self.kinds[h][min(c, 3)] += 1
        self.d2 = self.off(pairs.values())
        self.d1 = self.off(self.before.values())

    @staticmethod
    def off(counts):
        n = Counter(counts)
        return (0, *ngram_lm.discounts(n[1], n[2], n[3], n[4]))

    def single(self, w):
        total = sum(self.before.values())
        if not total:
            return 1.0
        taken = sum(self.d1[min(c, 3)] for c in self.before.values())
        c = self.before[w]
        return max(c - self.d1[min(c, 3)], 0) / total + taken / total / (len(self.before) + 1)

    def pair(self, h, w):
        if not self.total[h]:
            return self.single(w)
        c = self.pairs[h, w]
        spared = sum(self.d2[k] * n for k, n in self.kinds[h].items())
        return (max(c - self.d2[min(c, 3)], 0) + spared * self.single(w)) / self.total[h]

    def score(self, text):
        seen = ["begin", *sentence_tokens(text)]
        return sum(math.log10(self.pair(h, w)) for h, w in zip(seen, seen[1:], strict=False))

    def base(self, text):
        n, v = sum(self.count.values()), len(self.count)
        return sum(math.log10((self.count[t] + 1) / (n + v + 1)) for t in sentence_tokens(text))


def texts(seed, number=150):
    rng = random.Random(seed)
    words = ["the", "The", "of", "and", "é", *(f"w{i}" for i in range(60))]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = {i: " ".join(rng.choices(words, weights, k=rng.randrange(30))) for i in range(number)}
    return rows | {900: None, 901: "", 902: " \t\n", 903: "the of " * 4000}


@pytest.fixture(scope="module")
def scored(spark):
    rows = texts(1)
    docs = spark.createDataFrame([(k, t, 1.0) for k, t in rows.items()], "doc_id long, text string, score double")
    held = id_remainder("doc_id", 7) == 2
    model = ngram_lm.train(docs.filter(~held).repartition(4))
    got = ngram_lm.score_documents(docs, model, keep=(F.col("doc_id"), held.alias("held_out"))).collect()
    plain = Plain([rows[r.doc_id] for r in got if not r.held_out])
    return rows, got, plain, model


def test_scores_equal_the_plain_model(scored):
    rows, got, plain, _ = scored
    assert {r.doc_id for r in got} == set(rows) and any(r.held_out for r in got)
    for r in got:
        tokens = sentence_tokens(rows[r.doc_id])
        assert r.n_tokens == len(tokens)
        assert r.n_known == sum(plain.count[t] > 0 for t in tokens)
        assert r.train_tokens == sum(plain.count.values())
        assert r.base_score == pytest.approx(plain.base(rows[r.doc_id]))
        assert r.score == pytest.approx(plain.score(rows[r.doc_id]))


def test_probabilities_add_up(scored):
    _, _, plain, _ = scored
    for h in ("begin", "the".encode(), b"w3", b"never seen"):
        total = sum(plain.pair(h, w) for w in plain.count) + plain.pair(h, b"unknown")
        assert total == pytest.approx(1)


def test_model_beats_single_words_on_held_out_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = id_remainder("doc_id", 7) == 2
    model = ngram_lm.train(docs.filter(~held))
    row = ngram_lm.score_documents(docs.filter(held), model).agg(F.sum("score"), F.sum("base_score")).first()
    assert row[0] > row[1]


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = ngram_lm.train(docs.limit(0))
    rows = ngram_lm.score_documents(docs, model).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows] == [
        (3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0),
    ]
    assert ngram_lm.score_documents(docs.limit(0), model).collect() == []


def test_folder_that_cannot_be_mapped_is_refused(spark, monkeypatch):
    from packetflow.llm import common

    monkeypatch.setattr(common, "work_dir", lambda *_: "s3a://bucket/x")
    with pytest.raises(RuntimeError, match="mounted"):
        common.model_folder(spark, "x")
