import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from packetflow.llm import language, toxicity
from packetflow.llm.common import id_remainder


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=3), st.integers(0, 10**6))
def test_paths_are_the_best_of_all(lengths, seed):
    rng = np.random.default_rng(seed)
    scores = rng.normal(size=(7, 3)).astype(np.float32)
    codes = rng.integers(0, 7, sum(lengths))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    labels = language.best_paths(codes, offsets, scores, 1.0)
    for a, b in itertools.pairwise(offsets):

        def total(path, a=a):
            return sum(scores[codes[a + i], y] for i, y in enumerate(path)) - sum(
                x != y for x, y in itertools.pairwise(path)
            )

        best = max(itertools.product(range(3), repeat=b - a), key=total)
        assert total(tuple(labels[a:b])) == pytest.approx(total(best), abs=1e-4)


def languages(spark):
    rng = random.Random(8)
    sounds = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "ung", "er"], "gr": ["λο", "γο", "ς"], "ru": ["ка", "ни", "га"]}
    texts = []
    for i in range(160):
        lang = list(sounds)[i % 4]
        words = ["".join(rng.choices(sounds[lang], k=rng.randrange(2, 5))) for _ in range(rng.randrange(5, 40))]
        texts.append((i, " ".join(words) + ".", lang if i % 11 else None, 1.0))
    return spark.createDataFrame(texts, "doc_id long, text string, lang string, score double").repartition(3)


def test_languages_are_found(spark):
    docs = languages(spark)
    held = id_remainder("doc_id", 3) == 1
    model = language.train(docs.filter(~held))
    rows = language.predict(docs, model, (F.col("doc_id"), held.alias("held_out"))).collect()
    names = ["aa", "bb", "gr", "ru"]
    assert all(r.lang_pred == names[r.doc_id % 4] and r.score == 1 for r in rows)
    mixed = "kalo mika loka milo " * 3 + "schung erung unger schersch " * 3 + "каника гака никага " * 3
    odd = [(1, None), (2, ""), (3, "12 %% \n"), (4, mixed), (None, "kalo " * 100_000), (4, "中文字")]
    frame = spark.createDataFrame(odd, "doc_id long, text string")
    got = language.predict(frame, model, (F.col("doc_id"),), spans=True).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0, 0, 0]
    assert [(s.start, s.end, s.lang) for s in got[3].spans] == [(0, 12, "aa"), (12, 24, "bb"), (24, 33, "ru")]
    assert (got[4].lang_pred, got[4].score) == ("aa", 1.0)
    assert got[5].lang_pred in names


def test_nothing_learned_is_undetermined(spark):
    docs = languages(spark)
    model = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.predict(docs, model, (F.col("doc_id"),)).collect()} == {"und"}
    assert language.predict(docs.limit(0), model, ()).collect() == []


def test_held_out_languages_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = id_remainder("doc_id", 3) == 1
    model = language.train(docs.filter(~held))
    rows = language.predict(docs.filter(held), model, (F.col("lang"),)).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def insults(spark, number=400):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(number):
        text = rng.choices(words, k=rng.randrange(30, 90))
        toxic = i % 5 == 2
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                text.insert(rng.randrange(len(text)), rng.choice(["Moron!", "clown", "foulend", "foulish", "foulest"]))
        rows.append((i, " ".join(text), 0.5))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxic_texts_are_found(spark):
    docs, labels = insults(spark)
    held = id_remainder("doc_id", 5) == 0
    detector = toxicity.train(docs, labels, learn=~held)
    assert {"=clown", "foul"} & set(detector.lexicon.entries)
    rows = toxicity.score_documents(docs, detector, (F.col("doc_id"), held.alias("held_out"))).collect()
    assert len(rows) == 400 and all(0 <= r.score <= 1 for r in rows)
    wrong = [r for r in rows if r.held_out and r.predicted != (r.doc_id % 5 == 2)]
    assert len(wrong) <= 1
    odd = spark.createDataFrame([(1, None), (None, ""), (3, "w1 " * 200_000), (3, "w1 " * 200_000)], "doc_id long, text string")
    got = toxicity.score_documents(odd, detector, (F.col("doc_id"),)).collect()
    assert [r.predicted for r in got] == [0] * 4 and got[0].score == got[1].score
    assert toxicity.score_documents(odd.limit(0), detector, ()).collect() == []


def test_labels_that_teach_nothing(spark):
    docs, labels = insults(spark, 40)
    none = toxicity.train(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score_documents(docs, none, ()).collect()} == {1}  # even odds
    clean = toxicity.train(docs, labels.withColumn("toxic", F.lit(0)))
    assert {r.predicted for r in toxicity.score_documents(docs, clean, ()).collect()} == {0}


def test_label_model_finds_accuracies_and_shares_weight():
    rng = np.random.default_rng(2)
    truth = rng.random(6000) < 0.3
    hit = (0.8, 0.6, 0.7, 0.5)
    false = (0.05, 0.1, 0.02, 0.1)
    spoke = np.column_stack([rng.random(6000) < np.where(truth, p, q) for p, q in zip(hit, false, strict=True)])
    copies = np.column_stack([spoke, spoke[:, 0], spoke[:, 0]])
    given_label = np.where(rng.random(6000) < 0.95, truth, ~truth).astype(int)
    posterior, rates, weights = toxicity.label_model(copies, given_label, 0.3)
    assert ((posterior > 0.5) == truth).mean() > 0.97
    assert np.abs(rates[1][:4] - hit).max() < 0.05 and np.abs(rates[0][:4] - false).max() < 0.05
    assert weights[0] < 0.5 < weights[1]


def test_entries_match_words_and_beginnings():
    lexicon = toxicity.Lexicon(("=clown", "foul"))
    assert lexicon.match(["clown", "clowns", "foul", "fouler", ""]).tolist() == [0, -1, -1, 1, -1]
    counts, words, near = toxicity.hit_counts(pa.array(["clown x fouler", None, "x"]), lexicon)
    assert counts.tolist() == [[1, 1], [0, 0], [0, 0]] and words.tolist() == [3, 0, 1] and near.tolist() == [1, 0, 0]
