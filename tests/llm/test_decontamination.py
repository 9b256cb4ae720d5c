import random
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from packetflow.llm import decontamination as dec


def plain_tiles(text, item, least):
    """Greedy string tiling by the book: how many words of the item are covered."""
    free = [[True] * len(text), [True] * len(item)]
    covered = 0
    while True:
        best, places = least - 1, []
        for i in range(len(text)):
            for j in range(len(item)):
                n = 0
                while (
                    i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n]
                    and free[0][i + n] and free[1][j + n]
                ):
                    n += 1
                if n > best:
                    best, places = n, [(i, j)]
                elif n == best and n >= least:
                    places.append((i, j))
        if not places:
            return covered
        for i, j in places:
            if all(free[0][i : i + best]) and all(free[1][j : j + best]):
                free[0][i : i + best] = free[1][j : j + best] = [False] * best
                covered += best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=24), st.lists(st.integers(0, 3), max_size=16), st.integers(1, 4))
def test_tiles_are_those_of_the_plain_algorithm(text, item, least):
    got = dec.tiles(np.array(text, np.uint64), np.array(item, np.uint64), least)
    assert sum(n for _, _, n in got) == plain_tiles(text, item, least)
    for i, j, n in got:
        assert text[i : i + n] == item[j : j + n] and n >= least


WORDS = [f"w{i}" for i in range(5000)]


def corpus():
    rng = random.Random(5)
    items = {i: [rng.choice(WORDS) for _ in range(rng.randrange(15, 50))] for i in range(20)}
    docs, wanted = {}, set()
    for k in range(120):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(20, 200))]
        if k % 4 == 0:
            item = rng.randrange(20)
            planted = list(items[item])
            if k % 8 == 0:  # reordered in passages
                cut = len(planted) // 2
                planted = planted[cut:] + ["between"] * 3 + planted[:cut]
            if k % 12 == 0:
                planted = [w.upper() + "," for w in planted]
            words[10:10] = planted
            wanted.add((k, item))
        docs[k] = " ".join(words)
    return docs, {i: " ".join(w) for i, w in items.items()}, wanted


def frames(spark, docs, items):
    left = spark.createDataFrame([(k, t, 1) for k, t in docs.items()], "doc_id long, text string, item_id int")
    right = spark.createDataFrame([(k, t, 2) for k, t in items.items()], "item_id long, text string, doc_id int")
    return left.repartition(3), right


def test_planted_items_are_found_and_nothing_else(spark):
    docs, items, wanted = corpus()
    docs |= {900: None, 901: "", 902: "w1 w2"}
    items |= {50: None, 51: "", 52: "?!", 53: "two words"}
    docs[903] = "here are two words"
    left, right = frames(spark, docs, items)
    found = {(r.doc_id, r.item_id) for r in dec.contaminated(left, right).collect()}
    assert found == wanted | {(903, 53)}
    sliced = dec.contaminated(left, right, slice_chars=500).collect()
    assert {(r.doc_id, r.item_id) for r in sliced} == found and len(sliced) == len(found)
    clean = dec.without_items(left, right)
    assert clean.columns == left.columns
    assert {r.doc_id for r in clean.collect()} == set(docs) - {d for d, _ in found}


def test_half_of_an_item_decides(spark):
    item = [f"q{i}" for i in range(20)]
    docs = {1: " ".join(item[:10]), 2: " ".join(item[:9]), 3: " ".join(w for i in range(0, 20, 3) for w in item[i : i + 3] + ["x"])}
    left, right = frames(spark, docs, {7: " ".join(item)})
    rows = dec.contaminated(left, right).collect()
    assert [(r.doc_id, r.n_covered, r.n_item_words) for r in rows] == [(1, 10, 20)]


def test_empty_tables(spark):
    left, right = frames(spark, {1: "a b c d e"}, {})
    assert dec.contaminated(left.limit(0), right).collect() == []
    assert dec.contaminated(left, right).collect() == []
    assert dec.without_items(left, right).count() == 1


def test_repeated_rows_report_each_and_long_texts_pass(spark):
    item = " ".join(f"q{i}" for i in range(12))
    long = "w " * 200_000 + item
    docs = spark.createDataFrame([(1, item), (1, item), (None, long)], "doc_id long, text string")
    items = spark.createDataFrame([(4, item), (4, item), (None, item)], "item_id long, text string")
    rows = dec.contaminated(docs, items).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in rows) == sorted(
        [("1", "4"), ("1", "None")] * 2 + [("None", "4"), ("None", "None")]
    )


def test_whole_query_equals_plain_tiling_of_every_pair(spark):
    rng = random.Random(8)
    words = [f"v{i}" for i in range(9)]
    items = {i: [rng.choice(words) for _ in range(rng.randrange(1, 14))] for i in range(25)}
    docs = {k: [rng.choice(words) for _ in range(rng.randrange(0, 40))] for k in range(40)}
    for k in range(0, 40, 3):
        docs[k] = docs[k][:8] + items[k % 25] + docs[k][8:] + items[(k + 1) % 25][::-1]
    left, right = frames(
        spark, {k: " ".join(w) for k, w in docs.items()}, {i: " ".join(w) for i, w in items.items()}
    )
    wanted = set()
    for k, text in docs.items():
        for i, item in items.items():
            covered = plain_tiles(text, item, min(4, len(item)))
            if 2 * covered >= len(item):
                wanted.add((k, i, covered, len(item)))
    rows = dec.contaminated(left, right).collect()
    assert {(r.doc_id, r.item_id, r.n_covered, r.n_item_words) for r in rows} == wanted
    assert len(rows) == len(wanted) > 20


def test_repetitive_texts_and_shared_phrases_end_soon():
    begin = time.process_time()
    same = np.ones(100_000, np.uint64)
    assert sum(n for _, _, n in dec.tiles(same, same[:1000], 4)) == 1000
    assert sum(n for _, _, n in dec.tiles(np.tile(np.arange(7, dtype=np.uint64), 9000), same, 4)) == 0
    phrase = " ".join(f"p{i}" for i in range(12))
    items = dec.Items(
        list(range(10_000)),
        [f"{phrase} " + " ".join(f"i{n}x{k}" for k in range(30)) for n in range(10_000)], 4,
    )
    import pyarrow as pa

    texts = [f"{phrase} and more of it " * 200, "w " * 100_000, "", None]
    texts.append(" ".join(f"i77x{k}" for k in range(30)) + phrase)
    found = list(dec.find_items(pa.array(texts), items, 0.5))
    assert [(t, i) for t, i, *_ in found] == [(4, 77)]
    assert time.process_time() - begin < 20


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("a", "one two three four five")], "doc_id string, text string")
    items = spark.createDataFrame([("x", "two three four five")], "item_id string, text string")
    assert [(r.doc_id, r.item_id) for r in dec.contaminated(docs, items).collect()] == [("a", "x")]
