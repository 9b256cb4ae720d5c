import json

import pytest
from pyspark.sql import functions as F

from packetflow import schemas
from packetflow.operators import ingest, outbox, relay
from packetflow.streaming.relay import StoredOutbox

NOW = 1_000_000


def requests(spark, addresses):
    rows = [(i, 1, 2, a, "10.1.0.1", "m1", "m2", "UDP") for i, a in enumerate(addresses)]
    return spark.createDataFrame(rows, "n bigint, " + schemas.PACKET_REQUEST)


def added(spark, count, **options):
    df = requests(spark, ["10.0.0.1"] * count)
    snaps = ingest.ingest_packets(df, F.col("n") + 10, [F.lit("test"), F.col("n")])
    return outbox.outbox_rows(snaps, "SnapshotTopic", F.col("version"), **options)


def stored(df):
    """Cut the plan, as a table in between would."""
    return df.sparkSession.createDataFrame(df.collect(), schemas.OUTBOX)


def test_snapshot_of_a_request(spark):
    df = requests(spark, ["10.0.0.1", "", "  "])
    snaps = ingest.ingest_packets(df, F.lit(77), [F.lit("t"), F.col("n")]).orderBy("n").collect()
    assert [r["client_id"] for r in snaps] == ["10.0.0.1", "unknown", "unknown"]
    assert {r["version"] for r in snaps} == {77}
    assert len({r["transaction_id"] for r in snaps}) == 3
    again = ingest.ingest_packets(df, F.lit(77), [F.lit("t"), F.col("n")]).orderBy("n").collect()
    assert again == snaps


def test_append_keeps_payload_topic_key_and_metadata(spark):
    row = added(
        spark, 1, partition_by=F.col("source_ip"),
        metadata=F.create_map(F.lit("origin"), F.lit("intake")),
    ).first()
    assert json.loads(row["raw_data"])["source_ip"] == "10.0.0.1"
    assert (row["topic"], row["partition_by"]) == ("SnapshotTopic", "10.0.0.1")
    assert json.loads(row["metadata"]) == {"origin": "intake"}
    assert (row["is_processed"], row["is_processing"], row["reserved_at_ms"]) == (0, 0, None)
    assert added(spark, 1).first()["partition_by"] is None


def test_claims_take_the_oldest_and_hide_them_until_the_lease_ends(spark):
    rows = stored(added(spark, 5))
    claims = outbox.reserve(rows, NOW, limit=2, lease_ms=1000)
    got = claims.collect()
    assert sorted(r["date_timestamp_ms"] for r in got) == [10, 11]
    assert {(r["is_processing"], r["reserved_at_ms"], r["expired_at_ms"]) for r in got} == {
        (1, NOW, NOW + 1000)
    }
    after = stored(outbox.apply_claims(rows, claims, max_ids=2))
    assert after.filter("is_processing = 1").count() == 2
    assert outbox.eligible(after, NOW + 999).count() == 3
    assert outbox.eligible(after, NOW + 1000).count() == 5


def test_sequential_rows_are_left_alone(spark):
    both = added(spark, 1, is_sequential=True).unionByName(added(spark, 1))
    assert outbox.eligible(both, NOW).count() == 1


def test_workers_never_claim_the_same_row(spark):
    claims = outbox.worker_claims(added(spark, 40), NOW, workers=4, limit=40)
    audit = outbox.claim_audit(claims).first()
    assert (audit["claimed"], audit["distinct_claimed"]) == (40, 40)
    assert claims.select("worker").distinct().count() > 1


def test_processed_rows_leave_circulation_and_are_cleaned_up(spark):
    rows = stored(added(spark, 3))
    claims = outbox.reserve(rows, NOW, limit=2)
    done = stored(outbox.mark_processed(rows, claims, max_ids=2).select(*rows.columns))
    assert done.filter("is_processed = 1").count() == 2
    assert outbox.reserve(done, NOW).count() == 1
    assert outbox.cleanup(done).count() == 1


def test_tick_publishes_every_pending_row_once(spark):
    rows = stored(
        added(
            spark, 2, partition_by=F.col("source_ip"),
            metadata=F.create_map(F.lit("origin"), F.lit("intake")),
        )
    )
    tick = relay.relay_tick(rows, NOW)
    sent = tick.messages.collect()
    assert len(sent) == 2
    envelope = json.loads(sent[0]["value"])
    assert envelope["Topic"] == "SnapshotTopic"
    assert envelope["Key"] == sent[0]["key"] == "10.0.0.1"
    assert envelope["Metadata"] == {"origin": "intake"}
    assert envelope["Created"] == "1970-01-01T00:00:00.010Z" or sent[0]["id"]
    after = stored(tick.outbox)
    assert after.filter("is_processed = 1").count() == 2
    assert relay.relay_tick(after, NOW).messages.count() == 0


def test_failed_send_leaves_rows_pending(spark):
    rows = stored(added(spark, 1))
    relay.relay_tick(rows, NOW)  # the send fails, so the outbox of the tick is never written
    assert relay.relay_tick(rows, NOW).messages.count() == 1


def test_rows_without_topic_are_reported_and_stay(spark):
    rows = stored(added(spark, 1).withColumn("topic", F.lit("  ")))
    tick = relay.relay_tick(rows, NOW)
    assert tick.messages.count() == 0
    assert tick.errors.first()["error"] == "blank topic"
    assert tick.outbox.first()["is_processed"] == 0
    both = rows.unionByName(stored(added(spark, 1)).withColumns({"id": F.lit("z"), "date_timestamp_ms": F.lit(NOW)}))
    assert [r["id"] for r in relay.relay_tick(both, NOW, limit=1).messages.collect()] == ["z"]


def test_rows_without_a_first_field_get_ids_of_their_own(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "id string, n int")
    ids = [r["id"] for r in outbox.outbox_rows(rows, "T", F.lit(1), fields=["id", "n"]).collect()]
    assert len(set(ids)) == 3


def test_stored_outbox_keeps_claims_of_a_failed_send(spark, tmp_path):
    box = StoredOutbox(str(tmp_path / "box"), snapshot_every=4)
    box.load(stored(added(spark, 3)))
    sent = []

    def send(messages):
        sent.extend(r["id"] for r in messages.collect())

    def fail(messages):
        raise ConnectionError

    with pytest.raises(ConnectionError):
        box.tick(spark, 0, NOW, fail, limit=2, lease_ms=100)
    assert box.read(spark).filter("is_processing = 1 AND is_processed = 0").count() == 2
    box.tick(spark, 1, NOW + 50, send)  # the leases hold
    assert len(sent) == 1
    box.tick(spark, 2, NOW + 200, send)
    assert len(sent) == len(set(sent)) == 3
    box.tick(spark, 3, NOW + 300, send)
    assert len(sent) == 3
    assert box.read(spark).filter("is_processed = 0").count() == 0
    assert box.versions.snapshots.only(spark, 8).count() == 0  # rows that are done leave with a snapshot


def test_empty_outbox(spark):
    tick = relay.relay_tick(spark.createDataFrame([], schemas.OUTBOX), NOW)
    assert tick.messages.count() == 0 and tick.outbox.count() == 0


def test_equal_keys_share_a_partition(spark):
    rows = spark.createDataFrame([(f"k{i % 7}",) for i in range(100)], "key string")
    placed = relay.with_partition(rows).distinct().collect()
    assert len(placed) == 7
    assert all(0 <= r["partition_id"] < 5 for r in placed)


def test_intake_batches_and_counts(spark):
    df = requests(spark, ["a"] * 250 + ["b"] * 5)
    numbered = ingest.intake_batches(df, "source_ip", "n", size=100)
    sizes = {(r["source_ip"], r["batch_no"]): r["count"]
             for r in numbered.groupBy("source_ip", "batch_no").count().collect()}
    assert sizes == {("a", 0): 100, ("a", 1): 100, ("a", 2): 50, ("b", 0): 5}
    counts = {r["source_ip"]: r["accepted"] for r in ingest.accepted_counts(df, "source_ip").collect()}
    assert counts == {"a": 250, "b": 5}
