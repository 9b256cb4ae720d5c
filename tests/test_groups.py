"""Numbering and admission against loops, with one group holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from packetflow.operators import admission, ranking


@pytest.mark.parametrize(("width", "gap"), [(1, 1), (7, 1 << 20), (1 << 20, 1)])
def test_numbering_equals_a_sorted_loop(spark, width, gap):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(9)}", i) for i in rng.sample(range(5000), 600)]
    rows += [(None, n) for n in rng.sample(range(5000), 50)]
    # with gaps of any size between the numbers
    rows = [(g, n * gap) for g, n in rows]
    df = spark.createDataFrame(rows, "g string, n bigint")
    got = {(r["g"], r["n"]): r["no"] for r in ranking.number_within(df, ["g"], "n", "no", width).collect()}
    want, seen = {}, {}
    for g, n in sorted(rows, key=lambda r: r[1]):
        seen[g] = seen.get(g, 0) + 1
        want[g, n] = seen[g]
    assert got == want


@pytest.mark.parametrize("ranges", [256, 5])
def test_outliers_leave_no_large_range(spark, monkeypatch, ranges):
    monkeypatch.setattr(ranking, "RANGES", ranges)
    near = spark.range(20_000).select((F.col("id") * 3).alias("n"))
    far = spark.createDataFrame([(10**15,), (-(10**12),), (None,)], "n bigint")
    df = near.unionByName(far)
    cut = ranking.with_range(df, "n", 1000, "range")
    sizes = [r["count"] for r in cut.groupBy("range").count().collect()]
    assert sum(sizes) == 20_003 and max(sizes) < 2000 and len(sizes) <= 25
    numbered = ranking.number_within(df.filter("n IS NOT NULL"), [], "n", "no", 1000)
    got = [r["no"] for r in numbered.orderBy("n").collect()]
    assert got == list(range(1, 20_003))


@pytest.mark.parametrize("permits", [1, 3, 5000])
def test_admission_equals_a_counter_per_window(spark, permits):
    rng = random.Random(5)
    rows = [
        (i, rng.randrange(0, 400), "busy" if rng.random() < 0.6 else None,
         f"n{rng.randrange(3)}" if rng.random() < 0.5 else None,
         "10.0.0.1" if rng.random() < 0.5 else None)
        for i in range(700)
    ]
    calls = spark.createDataFrame(
        rows, "call_id bigint, ts_ms bigint, subject string, user_name string, remote_ip string"
    )
    got = {
        r["call_id"]: (r["caller"], r["admitted"])
        for r in admission.fixed_window_admission(calls, permits, 100).collect()
    }
    want, used = {}, {}
    for call, ts, subject, name, ip in sorted(rows, key=lambda r: (r[1], r[0])):
        caller = subject or name or ip or "anonymous"
        slot = (caller, ts // 100)
        used[slot] = used.get(slot, 0) + 1
        want[call] = (caller, int(used[slot] <= permits))
    assert got == want


def test_no_permits_is_an_error(spark):
    with pytest.raises(ValueError):
        admission.fixed_window_admission(None, 0)
