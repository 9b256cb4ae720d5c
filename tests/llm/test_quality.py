import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from packetflow.llm import quality_rules, site_quality
from packetflow.llm.logistic import Logistic, sigmoid


def base(text):
    words = (text or "").encode().split()
    lines = (text or "").split("\n")
    blank = " \t\n\x0b\x0c\r"
    seen, repeats = set(), 0
    for line in lines:
        if line.strip(blank):
            repeats += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    return {
        "n_words": len(words),
        "word_chars": sum(c not in blank for c in text or ""),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": repeats,
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab #|!9Zé \n\t\u00a0中", max_size=60)), min_size=1, max_size=6))
def test_base_counts(texts):
    got = quality_rules.judge(pa.array(texts, pa.string()), quality_rules.UNTRAINED, 0.5)
    for i, text in enumerate(texts):
        assert {k: got[k][i] for k in base(text)} == base(text)


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_decoding_is_the_best_of_all_labellings(data):
    lengths = data.draw(st.lists(st.integers(1, 6), min_size=1, max_size=4))
    seed = data.draw(st.integers(0, 10**6))
    rng = np.random.default_rng(seed)
    width = len(quality_rules.FEATURES)
    features = rng.integers(0, 2, (sum(lengths), width)).astype(np.uint8)
    field = quality_rules.Field(tuple(rng.normal(size=width)), tuple(map(tuple, rng.normal(size=(2, 2)))))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    labels = quality_rules.decode(features, bounds, field)
    score = features @ np.array(field.weights)
    for a, b in itertools.pairwise(bounds):

        def total(path, a=a):
            return sum(score[a + i] for i, y in enumerate(path) if y) + sum(
                field.pairs[x][y] for x, y in itertools.pairwise(path)
            )

        best = max(itertools.product((0, 1), repeat=b - a), key=total)
        assert total(tuple(labels[a:b])) == pytest.approx(total(best))


def corpus(spark, number=240):
    rng = random.Random(3)
    words = ["the", "of", "and", "river", "stone", "walks", "seldom", "under", "green", "light", *(f"w{i}" for i in range(400))]
    rows, labels = [], []
    for i in range(number):
        lines = [" ".join(rng.choices(words, k=rng.randrange(8, 20))).capitalize() + "." for _ in range(rng.randrange(6, 12))]
        bad = i % 4 == 0
        if bad:
            lines = [" ".join(w + rng.choice(["***", "$$$", "|"]) for w in line.split()) for line in lines]
            if i % 8 == 0:
                lines = [line.upper() + "!!" for line in lines]
        rows.append((i, "\n".join(lines), f"site{i % 7}", i, 0.0))
        if i % 3:
            labels.append((i, 0 if bad else 1, 0))
    schema = "doc_id long, text string, source string, label int, site_score double"
    docs = spark.createDataFrame(rows, schema).repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_rules_keep_content_and_drop_noise(spark):
    docs, labels = corpus(spark)
    field = quality_rules.train(docs, labels)
    got = {r.doc_id: r for r in quality_rules.score_documents(docs, field).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for i, text in texts.items():
        want = base(text)
        assert {k: got[i][k] for k in want} == want
        assert got[i].kept == (i % 4 != 0 and not want["base_failed"])
    kept = quality_rules.kept_documents(docs, field)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def odd_rows(spark):
    long = "\n".join(f"Line {i} says that word{i} is not word{i + 1}." for i in range(20_000))
    rows = [(None, None, None, 1), (1, "", "", 2), (2, " \n\n ", "http://A.org/x?y", 3), (3, long, "a", 4), (3, long, "a", 4)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, kept int")


def test_rules_on_odd_rows(spark):
    docs = odd_rows(spark)
    rows = quality_rules.score_documents(docs, quality_rules.UNTRAINED).collect()
    assert sorted((str(r.doc_id), r.n_words, r.kept) for r in rows) == [
        ("1", 0, False), ("2", 0, False), ("3", 160_000, True), ("3", 160_000, True), ("None", 0, False),
    ]
    assert quality_rules.score_documents(docs.limit(0), quality_rules.UNTRAINED).collect() == []
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.train(docs, none) == quality_rules.UNTRAINED
    mixed = spark.createDataFrame([(3, None), (3, 1), (None, 0), (77, 0)], "doc_id long, quality int")
    assert quality_rules.train(docs, mixed) == quality_rules.UNTRAINED


def test_classifier_and_sites(spark):
    docs, labels = corpus(spark)
    model = site_quality.train(docs, labels)
    rows = site_quality.score_documents(docs, model).collect()
    assert sum(r.kept == (r.doc_id % 4 != 0) for r in rows) >= 0.98 * len(rows)
    kept = site_quality.kept_documents(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}
    salted = site_quality.score_documents(docs, model, broadcast_paths=0).collect()
    assert {(r.doc_id, round(r.score, 9)) for r in salted} == {(r.doc_id, round(r.score, 9)) for r in rows}


def plain_sites(rows):
    """``{path: posterior}`` out of ``(host, path, score)``, by the formulas."""
    n, mean = len(rows), sum(s for *_, s in rows) / len(rows)
    within = sum(s * s for *_, s in rows) / n - mean**2
    hosts, paths = {}, {}
    for h, p, s in rows:
        hosts.setdefault(h, []).append(s)
        paths.setdefault((h, p), []).append(s)
    spread = sum(len(v) * (sum(v) / len(v) - mean) ** 2 for v in hosts.values())
    k = site_quality.prior_strength(spread, within, n, len(hosts), sum(len(v) ** 2 for v in hosts.values()))
    inner = sum(len(v) * (sum(v) / len(v) - sum(hosts[h]) / len(hosts[h])) ** 2 for (h, _), v in paths.items())
    extra = len(paths) - len(hosts)
    room = n - sum(len(v) ** 2 / len(hosts[h]) for (h, _), v in paths.items())
    between = (inner - extra * within) / room
    j = min(max(within / between if between > 0 else 1e6, 1), 1e6)
    result = {}
    for (h, p), v in paths.items():
        around = (sum(hosts[h]) + k * mean) / (len(hosts[h]) + k)
        result[p] = (sum(v) + j * around) / (len(v) + j)
    return result, mean


def test_posteriors_by_the_formulas(spark):
    rng = random.Random(6)
    rows = []
    for h in range(9):
        for p in range(rng.randrange(1, 5)):
            rate = rng.random()
            rows += [(f"h{h}", f"h{h}/p{p}", min(max(rng.gauss(rate, 0.2), 0.0), 1.0)) for _ in range(rng.randrange(1, 30))]
    frame = spark.createDataFrame(rows, "host string, path string, text_score double")
    want, mean = plain_sites(rows)
    got = site_quality.site_posteriors(frame).collect()
    assert {r.path: round(r.site_score, 9) for r in got} == {p: round(v, 9) for p, v in want.items()}
    assert got[0].global_score == pytest.approx(mean)
    sparse = min(want, key=lambda p: sum(q == p for _, q, _ in rows))
    own = [s for _, q, s in rows if q == sparse]
    assert abs(want[sparse] - mean) <= abs(sum(own) / len(own) - mean) + 0.35


def test_sites_of_odd_rows(spark):
    docs = odd_rows(spark)
    model = Logistic.fit(np.zeros((0, 10)), np.zeros(0))
    rows = site_quality.score_documents(docs, model).collect()
    assert sorted((str(r.doc_id), r.host, r.path, r.kept) for r in rows) == [
        ("1", "", "/", True), ("2", "a.org", "a.org/x", True), ("3", "a", "a/", True), ("3", "a", "a/", True),
        ("None", "", "/", True),
    ]
    assert site_quality.kept_documents(docs, model).count() == 5
    assert site_quality.score_documents(docs.limit(0), model).collect() == []
    assert site_quality.kept_documents(docs.limit(0), model).collect() == []


def test_logistic_finds_the_weights():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3))
    p = sigmoid(x @ np.array([2.0, -1.0, 0.0]) + 0.5)
    model = Logistic.fit(x, (rng.random(4000) < p).astype(float))
    assert np.abs(sigmoid(model.logit(x)) - p).mean() < 0.03
