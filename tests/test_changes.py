"""Parsing of change events against a small model, over documents made by rule."""

import json
import random

import pytest
from pyspark.sql import functions as F

from packetflow.operators import changes

TEXTS = ("client_id", "proto", "source_ip", "dest_ip")
NUMBERS = {"version": 63, "source_port": 31, "dest_port": 31}
ABSENT = object()


def text_states(rng):
    return [ABSENT, None, "", " " * rng.randrange(1, 3), f"v{rng.randrange(99)}", rng.randrange(99), {"x": 1}, ["x"]]


def number_states(rng, bits):
    good = rng.randrange(1 << (bits - 1))
    return [ABSENT, None, good, -good, str(good), good + 0.5, "w" + str(good), 1 << bits, {"x": good}]


def document(rng):
    """One field after the other in a random state; most of them good, else all would be bad."""
    doc = {}
    for name in ("__op", "transaction_id", *TEXTS, *NUMBERS, "storedAt", "other"):
        states = number_states(rng, NUMBERS[name]) if name in NUMBERS else text_states(rng)
        if name == "__op":
            states = [ABSENT, "c", "r", "u", "d", {"x": 1}]
        if name == "storedAt":
            states = [ABSENT, None, rng.randrange(1 << 40), "some words", {"x": 1}, [1], 1 << 62]
        usual = {"__op": "c", "transaction_id": f"t{rng.randrange(10**6)}"}.get(name, ABSENT)
        value = rng.choice(states) if rng.random() < 0.25 else usual
        if value is not ABSENT:
            doc[name] = value
    items = list(doc.items())
    rng.shuffle(items)
    return dict(items)


def nested(value):
    return isinstance(value, dict | list)


def bad_number(value, bits):
    if value is None:
        return False
    try:
        return nested(value) or isinstance(value, float) or abs(int(value)) >= 1 << bits
    except ValueError:
        return True


def reason(doc):
    op, tx = doc.get("__op"), doc.get("transaction_id")
    if op == "d":
        return "delete"
    if nested(op) or nested(tx):
        return "bad_type"
    if tx is None or not str(tx).strip():
        return "no_key"
    stored = doc.get("storedAt")
    bad = nested(stored) or (isinstance(stored, int) and stored >= 253402300800000)
    bad |= any(nested(doc.get(n)) for n in TEXTS)
    bad |= any(bad_number(doc.get(n), bits) for n, bits in NUMBERS.items())
    return "bad_type" if bad else None


def feed_of(spark, values):
    rows = [(i, 1000 * i, i % 5, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "arrival_seq bigint, arrival_ms bigint, msg_partition bigint, value string")


def parse(spark, values):
    return changes.parse_changes(feed_of(spark, values)).orderBy("arrival_seq").collect()


@pytest.mark.parametrize("seed", range(4))
def test_documents_by_rule(spark, seed):
    rng = random.Random(seed)
    docs = [document(rng) for _ in range(300)]
    rows = parse(spark, [json.dumps(d, indent=rng.choice([None, 1])) for d in docs])
    assert len({r["skip_reason"] for r in rows}) == 4
    for doc, row in zip(docs, rows, strict=True):
        assert row["skip_reason"] == reason(doc), doc
        if row["skip_reason"] is None:
            for name in TEXTS:
                value = doc.get(name)
                default = "OTHER" if name == "proto" else ""
                assert row[name] == (default if value is None else str(value))
            for name in NUMBERS:
                assert row[name] == int(doc.get(name) or 0)
            stored = doc.get("storedAt")
            at = row["stored_at"] and row["stored_at"].timestamp()
            assert at == (stored / 1000 if isinstance(stored, int) else None)


def test_damaged_text_is_malformed_and_nothing_is_a_tombstone(spark):
    rng = random.Random(9)
    whole = [json.dumps({"transaction_id": f"t{i}", "n": {"a": [i]}}) for i in range(60)]
    cut = [w[: rng.randrange(1, len(w))] for w in whole]
    more = [w + rng.choice(["]", " x", "}", ",{}", "] x"]) for w in whole]
    other = [json.dumps(v) for v in ([1], "s", 5, None, True, [{"transaction_id": "t"}])]
    none = [None, *(" " * n + "\t" * (n % 2) for n in range(4))]
    rows = parse(spark, [*cut, *more, *other, *none])
    assert [r["skip_reason"] for r in rows] == ["malformed"] * (120 + len(other)) + ["tombstone"] * len(none)


def test_quarantine_records_and_counts_part_the_feed(spark):
    rng = random.Random(5)
    docs = [document(rng) for _ in range(200)]
    parsed = changes.parse_changes(feed_of(spark, [json.dumps(d) for d in docs]))
    reasons = [reason(d) for d in docs]

    def numbers(frame):
        return sorted(r["arrival_seq"] for r in frame.collect())

    assert numbers(changes.quarantined(parsed)) == [i for i, r in enumerate(reasons) if r == "bad_type"]
    assert numbers(changes.records(parsed)) == [i for i, r in enumerate(reasons) if r is None]
    counts = {r["skip_reason"]: r["events"] for r in changes.skipped_counts(parsed).collect()}
    assert counts == {r: reasons.count(r) for r in set(reasons) - {None}}


def test_payload_is_the_document(spark):
    rng = random.Random(6)
    docs = [d for d in (document(rng) for _ in range(80)) if reason(d) is None]
    rows = changes.with_payload(changes.records(changes.parse_changes(feed_of(spark, [json.dumps(d) for d in docs]))))
    got = rows.orderBy("arrival_seq").select(
        F.to_json("payload").alias("text"),
        changes.payload_field(F.col("payload"), "other").alias("other"),
        changes.payload_field(F.col("payload"), "never there").alias("absent"),
    ).collect()
    assert [json.loads(r["text"]) for r in got] == docs
    for row, doc in zip(got, docs, strict=True):
        value = doc.get("other")
        assert row["absent"] is None
        assert nested(value) or row["other"] == (None if value is None else str(value))


def test_union_of_feeds_goes_by_name(spark):
    frames = [
        spark.createDataFrame([(f"{k}{i}", i) for i in range(k)], "topic string, n int") for k in range(1, 4)
    ]
    turned = [f.select("n", "topic") if i % 2 else f for i, f in enumerate(frames)]
    rows = changes.union_feeds(*turned).collect()
    assert sorted((r["topic"], r["n"]) for r in rows) == [(f"{k}{i}", i) for k in range(1, 4) for i in range(k)]
