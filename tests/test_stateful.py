"""Streams with state: seen transactions, live statistics, permits."""

import json
import random

import pytest

from packetflow import schemas
from packetflow.operators import admission
from packetflow.sources.topics import file_topic, file_topics
from packetflow.streaming.stateful import Admission, LiveStats, SeenLedger

FEED = schemas.CHANGE_EVENT + ", processed_ms BIGINT"
CALLS = "call_id BIGINT, ts_ms BIGINT, subject STRING, user_name STRING, remote_ip STRING"
DAY = 86_400_000


def event(tx, proto="TCP"):
    return json.dumps({"__op": "c", "transaction_id": tx, "client_id": "c", "version": 1, "proto": proto})


def test_seen_ledger_is_exact_and_its_state_is_bounded(spark, tmp_path):
    seen = SeenLedger(str(tmp_path / "seen"), window="2 days", delay="1 hour", ledger_every=2, ledger_buckets=2)
    source = str(tmp_path / "feed")
    rng = random.Random(2)
    wanted, rows_of_state, dropped, number = {}, [], 0, 0
    for batch in range(5):
        rows = []
        for _ in range(40):
            tx = f"t{rng.randrange(10)}" if rng.random() < 0.6 else f"b{batch}-{rng.randrange(12)}"
            number += 1
            # within a batch the smallest arrival number is the first, wherever it stands
            rows.append((1000 * batch + rng.randrange(900) * 1, number, "T", 0, event(tx, f"p{number}"), batch * 2 * DAY + 1))
        for row in sorted(rows, key=lambda r: (r[0], r[4])):
            tx = json.loads(row[4])["transaction_id"]
            wanted.setdefault(tx, row[0])
        spark.createDataFrame(rows, FEED).repartition(3).write.mode("append").parquet(source)
        query = seen.start(file_topic(spark, source, FEED), str(tmp_path / "cp"))
        query.awaitTermination()
        for state in (s for p in query.recentProgress for s in p["stateOperators"]):
            rows_of_state.append(state["numRowsTotal"])
            dropped += state["numRowsDroppedByWatermark"]
    got = {r["transaction_id"]: r["arrival_seq"] for r in seen.read(spark).collect()}
    assert got == wanted
    # the windows of three batches at most, until the watermark has passed the first
    assert dropped == 0 and max(rows_of_state) <= 3 * 22


def test_live_statistics_after_every_batch(spark, tmp_path):
    live, source, totals = LiveStats(str(tmp_path / "live")), str(tmp_path / "ledger"), {}
    for batch in range(3):
        rows = [(f"t{batch}-{i}", f"p{i % (batch + 2)}") for i in range(6)]
        df = spark.createDataFrame(rows, "transaction_id STRING, proto STRING")
        df.selectExpr("*", "timestamp_millis(1000) AS stored_at").write.mode("append").parquet(source)
        schema = "transaction_id STRING, proto STRING, stored_at TIMESTAMP"
        live.start(spark.readStream.schema(schema).parquet(source), str(tmp_path / "cp")).awaitTermination()
        for _, proto in rows:
            totals[proto] = totals.get(proto, 0) + 1
        assert {r["proto"]: r["packet_count"] for r in live.read(spark).collect()} == totals
    assert sum(r["packet_count"] for r in live.read(spark, 0).collect()) == 6
    with pytest.raises(ValueError, match="another checkpoint"):
        live.start(spark.readStream.schema(schema).parquet(source), str(tmp_path / "other"))


def test_permits_are_carried_from_batch_to_batch(spark, tmp_path):
    rng = random.Random(6)
    rows = sorted(
        (rng.randrange(1000), i, "busy" if rng.random() < 0.6 else f"u{rng.randrange(4)}") for i in range(300)
    )
    calls = [(i, ts, who, None, None) for ts, i, who in rows]
    limits = Admission(str(tmp_path / "limits"), permits=5, window_ms=100, late_ms=150, snapshot_every=2)
    for part in range(5):
        frame = spark.createDataFrame(calls[60 * part : 60 * part + 60], CALLS)
        frame.write.mode("append").parquet(str(tmp_path / "calls"))
        stream = spark.readStream.schema(CALLS).parquet(str(tmp_path / "calls"))
        limits.start(stream, str(tmp_path / "cp")).awaitTermination()
    got = {r["call_id"]: r["admitted"] for r in limits.read(spark).collect()}
    whole = admission.fixed_window_admission(spark.createDataFrame(calls, CALLS), 5, 100)
    assert got == {r["call_id"]: r["admitted"] for r in whole.collect()}
    limits.decide(spark.createDataFrame([(999, 5, "late", None, None)], CALLS), 0, "hand")
    late = limits.read(spark).filter("call_id = 999").first()
    assert late["admitted"] == 0
    kept = limits.used.snapshots.read(spark).agg({"window_start_ms": "min"}).first()[0]
    assert kept > 0  # windows long over are forgotten


def test_topics_are_picked_by_name_and_found_when_they_appear(spark, tmp_path):
    root, rows = str(tmp_path / "topics"), str(tmp_path / "rows")

    def write(*pairs):
        frame = spark.createDataFrame(pairs, "topic STRING, value STRING")
        frame.write.mode("append").partitionBy("topic").parquet(root)

    for pairs in ([("pcap.tcp.packets", "a"), ("orders", "x"), ("pcap.old", "y")],
                  [("pcap.udp.packets", "b"), ("copy.pcap.udp.packets", "z"), ("pcap.tcp.packets", "c")]):
        write(*pairs)
        sink = file_topics(spark, root, max_files=1).writeStream.format("parquet").option("path", rows)
        sink.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema("value STRING, topic STRING").parquet(rows).collect()
    assert sorted((r["topic"], r["value"]) for r in got) == [
        ("pcap.tcp.packets", "a"), ("pcap.tcp.packets", "c"), ("pcap.udp.packets", "b"),
    ]
