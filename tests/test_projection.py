import random

import pytest
from pyspark.sql import functions as F

from packetflow.operators import projection as pj
from packetflow.operators import stats

DDL = (
    "transaction_id string, client_id string, version bigint, proto string, arrival_seq bigint, "
    "arrival_ms bigint, stored_at timestamp"
)


def recs(spark, rows):
    """(transaction, client, version, proto) in order of arrival."""
    full = [(tx, c, v, p, i, 1000 + i, None) for i, (tx, c, v, p) in enumerate(rows)]
    return spark.createDataFrame(full, DDL)


def state(df):
    return {r["client_id"]: (r["version"], r["last_proto"]) for r in df.collect()}


def test_first_arrival_wins(spark):
    df = recs(spark, [("a", "c", 1, "TCP"), ("a", "c", 9, "DNS"), ("b", "c", 1, "UDP")])
    rows = {r["transaction_id"]: r["proto"] for r in pj.first_arrivals(df).collect()}
    assert rows == {"a": "TCP", "b": "UDP"}


@pytest.mark.parametrize("batch_rows", [None, 2])
def test_stored_transactions_are_not_inserted_again(spark, batch_rows):
    firsts = recs(spark, [("a", "c", 1, "TCP"), ("b", "c", 1, "UDP")])
    ledger = recs(spark, [("a", "c", 1, "TCP"), ("z", "c", 1, "TCP")])
    new = pj.new_ledger_rows(firsts, ledger, batch_rows)
    assert [r["transaction_id"] for r in new.collect()] == ["b"]


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([("a", "c1", 5, "HTTPS"), ("b", "c1", 3, "TCP")], (5, "HTTPS")),
        ([("a", "c1", 1, "TCP"), ("b", "c1", 9, "DNS")], (9, "DNS")),
        ([("a", "c1", 4, "HTTPS"), ("b", "c1", 4, "TCP")], (4, "HTTPS")),
    ],
)
def test_version_guard(spark, rows, want):
    assert state(pj.client_winners(recs(spark, rows))) == {"c1": want}
    parts = [pj.client_winners(recs(spark, [row])) for row in rows]
    assert state(pj.merge_client_state(*parts)) == {"c1": want}


def test_clients_are_independent_and_time_is_that_of_the_winner(spark):
    df = recs(spark, [("a", "c1", 10, "TCP"), ("b", "c2", 2, "UDP"), ("d", "c1", 3, "DNS")])
    rows = {r["client_id"]: r["updated_at_ms"] for r in pj.client_winners(df).collect()}
    assert rows == {"c1": 1000, "c2": 1001}


def markers(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, marked_at_ms bigint")


def test_expired_markers_do_not_stop_anything(spark):
    firsts = recs(spark, [("a", "c", 1, "TCP"), ("b", "c", 1, "TCP"), ("d", "c", 1, "TCP")])
    seen = markers(spark, [("a", 950), ("b", 900)])
    passed = pj.fast_path(firsts, seen, now_ms=1000, ttl_ms=100)
    assert sorted(r["transaction_id"] for r in passed.collect()) == ["b", "d"]


def test_marking_refreshes_the_expiry(spark):
    seen = markers(spark, [("a", 950), ("b", 800), ("old", 800)])
    stored = recs(spark, [("b", "c", 1, "TCP")])
    rows = pj.update_markers(seen, stored, now_ms=1000, ttl_ms=100).collect()
    assert {r["transaction_id"]: r["marked_at_ms"] for r in rows} == {"a": 950, "b": 1000}


def outcomes_one_by_one(events, seen, ledger):
    """The handler as a loop over single events."""
    seen, ledger, counts = set(seen), set(ledger), {}
    for tx in events:
        if tx is None:
            outcome = "Skipped"
        elif tx in seen:
            outcome = "FastPathSkip"
        else:
            outcome = "Duplicate" if tx in ledger else "Projected"
            ledger.add(tx)
            seen.add(tx)
        counts[outcome] = counts.get(outcome, 0) + 1
    return counts


def test_outcomes_equal_the_event_loop_also_for_a_hot_transaction(spark):
    rng = random.Random(7)
    events = [rng.choice(["hot", None, f"tx-{rng.randrange(60)}"]) for _ in range(900)]
    seen, ledger = [f"tx-{i}" for i in range(0, 20)], [f"tx-{i}" for i in range(10, 40)]
    parsed = spark.createDataFrame(
        [(None if tx else "malformed", tx) for tx in events],
        "skip_reason string, transaction_id string",
    )
    got = pj.outcome_counts(
        parsed,
        markers(spark, [(tx, 1000) for tx in seen]),
        spark.createDataFrame([(tx,) for tx in ledger], "transaction_id string"),
        now_ms=1001,
    )
    want = outcomes_one_by_one(events, seen, ledger)
    assert {r["outcome"]: r["events"] for r in got.collect()} == want


def test_statistics_bounds_and_merge(spark):
    rows = [("TCP", 0), ("TCP", 120), ("TCP", 60), ("UDP", 30), ("UDP", 90), ("ARP", None)]
    df = spark.createDataFrame(rows, "proto string, s int").withColumn(
        "stored_at", F.timestamp_seconds("s")
    )
    whole = stats.protocol_stats(df)
    parts = [stats.protocol_stats(df.filter(F.coalesce("s", F.lit(0)) < 60)),
             stats.protocol_stats(df.filter(F.col("s") >= 60))]
    columns = ["proto", "packet_count", F.unix_seconds("first_seen"), F.unix_seconds("last_seen")]
    want = [("ARP", 1, None, None), ("TCP", 3, 0, 120), ("UDP", 2, 30, 90)]
    for result in (whole, stats.merge_stats(*parts)):
        assert sorted(tuple(r) for r in result.select(*columns).collect()) == want
    order = [r["proto"] for r in stats.protocols_by_count(whole).collect()]
    assert order == ["TCP", "UDP", "ARP"]


def test_latest_clients(spark):
    rows = [(f"c{i}", 1, "TCP", i) for i in range(5)]
    df = spark.createDataFrame(rows, "client_id string, version int, last_proto string, updated_at_ms int")
    assert [r["client_id"] for r in stats.latest_clients(df, 2).collect()] == ["c4", "c3"]
