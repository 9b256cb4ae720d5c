import numpy as np
import pytest
from pyspark.sql import functions as F

from packetflow.llm import hard_negatives as hn

SCHEMA = "id long, label long, vector array<bigint>"


def plain(rows, anchors, k=5, n=10, least=30, most=90):
    result = []
    for a in anchors:
        scored = [(int(np.dot(a[2], r[2])), r) for r in rows if r[0] != a[0]]
        order = sorted(scored, key=lambda x: (-x[0], x[1][0]))
        for p, row in [x for x in order if x[1][1] == a[1]][:k]:
            window = [x for x in order if x[1][1] != a[1] and least * p <= 100 * x[0] <= most * p]
            for rank, (score, other) in enumerate(window[:n], 1):
                result.append((a[0], row[0], rank, other[0], p, score))
    return sorted(result)


def vectors(seed, count, dims=6, spread=40):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-100, 100, (4, dims))
    labels = rng.integers(0, 4, count)
    noise = rng.integers(-spread, spread, (count, dims))
    return [
        (int(i), int(c), [int(x) for x in centres[c] + d])
        for i, (c, d) in enumerate(zip(labels, noise, strict=True))
    ]


@pytest.mark.parametrize("block_rows", [7, 512])
def test_all_windows_equal_plain_code(spark, block_rows):
    rows = vectors(1, 400)
    rows += [(1000 + i, 1, rows[3][2]) for i in range(60)]  # one very common vector
    rows += [(2000 + i, i % 2, [0] * 6) for i in range(20)]  # scores of zero, ties throughout
    found = hn.mine(
        spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0, block_rows=block_rows
    ).collect()
    assert sorted(map(tuple, found)) == plain(rows, [r for r in rows if r[0] % 20 == 0])


def test_blocks_are_left_out(spark, tmp_path):
    rows = vectors(2, 2000, dims=3, spread=4)
    folder = str(tmp_path)
    hn.mine(
        spark.createDataFrame(rows, SCHEMA), F.col("id") == 0, block_rows=20, folder=folder
    ).collect()
    shape = hn.Shape(3, max(abs(x) for r in rows for x in r[2]))
    blocks = hn.Blocks(folder, shape)
    total = sum(len(z.files) for z in blocks.zones())
    anchor = hn.Slice(
        np.array([0]), np.array([rows[0][1]]), np.array([rows[0][2]]).astype(shape.exact)
    )
    best = hn.positives(anchor, blocks, 5)
    assert len(best.ids) == 5 and 0 < blocks.read_blocks < total / 4


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.25], 1, "x"), (2, [0.5, None], 1, "x"), (3, [nan, 0.1], 1, "x"),
        (4, [inf, 0.1], 1, "x"), (5, None, 1, "x"), (6, [0.1, 0.1], None, "x"),
        (None, [0.1, 0.1], 1, "x"), (7, [0.001, -0.001], 2, "x"),
    ]
    df = spark.createDataFrame(rows, "key long, emb array<float>, y int, vector string")
    got = {tuple(r) for r in hn.usable(df, "key", "emb", F.col("y")).select("id", "label").collect()}
    assert got == {(1, 1), (7, 2)}
    kept = hn.usable(df, "key", "emb", F.col("y")).filter("id = 7").first()
    assert kept.vector == [0, -1]


def test_empty_repeated_short_and_large(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hn.mine(none, F.col("id") % 2 == 0).collect() == []
    big = 1 << 27  # products beyond what a double holds exactly
    rows = [
        (0, 1, [big, 1]), (0, 1, [big, 1]), (1, 1, [big, 3]), (1, 1, [big, 3]), (2, 1, [7]),
        (3, 2, [big // 2, 5]), (3, 2, [big // 2, 5]), (4, 2, [big // 2]), (5, 2, []),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = hn.mine(df, F.col("id") == 0).collect()
    full = [(i, c, [*v, 0, 0][:2]) for i, c, v in rows]
    # the anchor is searched for once
    assert sorted(map(tuple, got)) == plain(full, full[:1])
    assert {r.negative_id for r in got} == {3, 4}


def test_the_curve_moves_one_cell_at_a_time():
    side, bits = 8, 3
    cells = np.array([(i, j, k) for i in range(side) for j in range(side) for k in range(side)])
    order = np.argsort(hn.hilbert_keys(cells, bits))
    assert sorted(hn.hilbert_keys(cells, bits)) == list(range(side**3))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()
