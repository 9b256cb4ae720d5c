import random

import numpy as np

from packetflow.llm import jaccard_join
from packetflow.llm.components import components


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute_force(texts, threshold=80):
    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= threshold * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


def near_copies(seed, groups=12, size=9):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    passage = [rng.choice(words) for _ in range(30)]
    texts, key = {}, 0
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.randrange(8, 70))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.randrange(1, size)):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts[key] = " ".join(copy[: rng.randrange(len(copy) * 8 // 10, len(copy) + 1)])
            key += 1
    return texts


def frame(spark, texts):
    rows = [(k, t, "x", 1) for k, t in texts.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, set string, n int").repartition(3)


def test_components_equal_all_pairs(spark):
    texts = near_copies(1) | {1000: None, 1001: "", 1002: " \n", 1003: "a b", 1004: "A  b", 1005: "a b c d e"}
    got = jaccard_join.linked_documents(frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_force(texts)
    assert len(got) == len(texts)


def test_cutting_groups_into_blocks_loses_no_link(spark):
    texts = near_copies(2, groups=3, size=14)
    got = jaccard_join.linked_documents(frame(spark, texts), task_ngrams=150).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_force(texts)


def test_tree_finds_the_links_of_all_pairs():
    for seed in range(30):
        rng = np.random.default_rng(seed)
        sets = []
        for _ in range(4):
            base = rng.choice(60, 25, replace=False)
            sets += [np.unique(np.where(rng.random(25) < 0.08, rng.integers(0, 60, 25), base)) for _ in range(6)]
        df = np.bincount(np.concatenate(sets), minlength=60)
        ordered = [s[np.lexsort((s, df[s]))].astype(np.uint64) for s in sets]
        sizes = [len(s) for s in sets]
        links = jaccard_join.tree_links(ordered, [df[s.astype(int)].astype(np.uint32) for s in ordered], sizes, 80)
        root = list(range(len(sets)))

        def merge(pairs, root):
            for a, b in pairs:
                root = [root[a] if x == root[b] else x for x in root]
            return root

        wanted = [
            (i, j) for i in range(len(sets)) for j in range(i)
            if (o := len(np.intersect1d(sets[i], sets[j]))) * 100 >= 80 * (sizes[i] + sizes[j] - o)
        ]
        a, b = merge(links, root), merge(wanted, root)
        assert len(set(a)) == len(set(b)) == len(set(zip(a, b, strict=True)))
        assert set(map(frozenset, links)) <= set(map(frozenset, wanted))


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(5, text), (5, text), (3, text), (None, text), (None, "other words that stand here alone"), (9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((str(r.doc_id), r.component_id) for r in jaccard_join.linked_documents(docs).collect()), key=str)
    assert got == [("3", 3), ("5", 3), ("5", 3), ("9", 9), ("None", 3), ("None", None)]


def test_number_of_links_is_that_of_all_pairs(spark):
    texts = near_copies(5, groups=3, size=14)
    texts |= {500 + k: texts[k] for k in (0, 1, 4)} | {600: "a b", 601: "A b", 602: "", 603: ""}
    texts |= {700 + k: " ".join(f"v{i}" for i in range(40)) + f" end{k}" for k in range(8)}
    sets = {k: shingles(t) for k, t in texts.items()}

    def linked(a, b):
        same = len(a & b)
        return same > 0 and 100 * same >= 80 * (len(a) + len(b) - same)

    wanted = {k: sum(linked(s, sets[j]) for j in sets if j != k) for k, s in sets.items()}
    assert max(wanted.values()) > 4
    for task_ngrams in (jaccard_join.TASK_NGRAMS, 150):
        got = jaccard_join.linked_documents(frame(spark, texts), task_ngrams=task_ngrams).collect()
        assert {r.doc_id: r.n_links for r in got} == wanted


def test_tree_counts_all_pairs_in_steps_of_any_size():
    for seed in range(12):
        rng = np.random.default_rng(seed)
        bases = [rng.choice(60, 25, replace=False) for _ in range(4)]
        sets = [np.unique(np.where(rng.random(25) < 0.08, rng.integers(0, 60, 25), bases[k % 4])) for k in range(24)]
        df = np.bincount(np.concatenate(sets), minlength=60)
        ordered = [s[np.lexsort((s, df[s]))].astype(np.uint64) for s in sets]
        sizes, copies, blocks = [len(s) for s in sets], rng.integers(1, 4, 24), rng.integers(0, 2, 24)
        numbers = [df[s.astype(int)].astype(np.uint32) for s in ordered]
        pairs = [
            (i, j) for i in range(24) for j in range(24)
            if i != j and (o := len(np.intersect1d(sets[i], sets[j]))) * 100 >= 80 * (sizes[i] + sizes[j] - o)
        ]
        for own in (None, blocks):
            wanted = [sum(copies[j] for i, j in pairs if i == k and (own is None or own[i] != own[j])) for k in range(24)]
            for step in (1, 60, 1 << 14):
                links, degrees = jaccard_join.tree_joins(ordered, numbers, sizes, 80, copies, own, step)
                assert degrees.tolist() == wanted
                assert own is None or all(own[a] != own[b] for a, b in links)


def test_one_of_each_keeps_the_smallest(spark):
    texts = near_copies(3)
    wanted = {c for _, c in brute_force(texts).values()}
    docs = frame(spark, texts)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(wanted)
    twice = jaccard_join.one_of_each(docs.unionByName(docs))
    assert sorted(r.doc_id for r in twice.collect()) == sorted(wanted)


def test_one_of_each_keeps_different_texts_of_one_id(spark):
    def words(name, n=20):
        return " ".join(f"{name}{i}" for i in range(n))

    rows = [
        (3, words("a")), (7, words("a")), (7, words("b")), (7, words("c")), (7, words("c")),
        (7, words("c") + " more"), (8, words("d")), (8, words("e")), (8, words("e")), (9, words("f")), (9, None),
        (None, words("a")), (10, words("b")),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id int, text string, set string").repartition(3)
    kept = sorted(((r.doc_id or 0, r.text or "") for r in jaccard_join.one_of_each(docs).collect()), key=str)
    seven = [t for i, t in kept if i == 7]
    assert len(seven) == 2 and words("b") in seven and any(t.startswith(words("c")) for t in seven)
    wanted = [(0, words("a")), (3, words("a")), (8, words("d")), (8, words("e")), (9, ""), (9, words("f"))]
    assert [r for r in kept if r[0] != 7] == wanted


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.linked_documents(docs).collect() == []
    assert jaccard_join.one_of_each(docs).collect() == []


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    edges += [(200 + rng.randrange(60), 200 + rng.randrange(60)) for _ in range(40)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in got} == {k: v for k, v in root.items() if k not in alone}
    assert len(got) == len(root) - len(alone)
