import json

import pytest
from pyspark.sql import functions as F

from packetflow import schemas
from packetflow.functions import api_key_hash
from packetflow.operators import auth, joins, routing

#: A value for every field of a snapshot, by its type.
PACKET = {
    name: f"some {name}" if kind == "STRING" else number
    for number, (name, kind) in enumerate(field.split() for field in schemas.SNAPSHOT.split(","))
} | {"proto": "UDP"}


def packet(**changes):
    return json.dumps({**PACKET, **changes})


def envelope(payload, **changes):
    body = {
        "Topic": "SnapshotTopic", "Key": "k", "Payload": payload, "PayloadType": "SnapshotMessage",
        "Metadata": {"origin": "intake"}, "Created": "2024-01-01T00:00:00Z", **changes,
    }
    return json.dumps(body)


def messages(spark, *values, attempts=None):
    headers = None if attempts is None else [("attempts", bytearray(attempts))]
    rows = [("SnapshotTopic", 0, i, 5000 + i, f"k{i}", v, headers, "key") for i, v in enumerate(values)]
    return spark.createDataFrame(rows, schemas.TOPIC_MESSAGE)


def verdicts(spark, *values, down=()):
    rows = routing.route(messages(spark, *values), down).orderBy("msg_offset").collect()
    return [(r["verdict"], r["reason"]) for r in rows]


STORED = ("settled", "stored")
EMPTY = ("settled", "empty_payload")
BAD_ENVELOPE = ("rejected", "malformed_envelope")
BAD_PAYLOAD = ("rejected", "malformed_payload")
DOWN = ("rejected", "shard_down")


@pytest.mark.parametrize(
    ("value", "verdict"),
    [
        (envelope(packet()), STORED),
        (envelope(packet(proto="ICMP")), STORED),
        (envelope("   "), EMPTY),
        (envelope(None), EMPTY),
        ("{}", EMPTY),
        ("{ bad envelope", BAD_ENVELOPE),
        (None, BAD_ENVELOPE),
        (envelope(packet()) + " x", BAD_ENVELOPE),
        (envelope(PACKET), BAD_ENVELOPE),
        (envelope(packet(), Created="yesterday"), BAD_ENVELOPE),
        (envelope(packet(), Metadata="text"), BAD_ENVELOPE),
        (envelope("this is not json"), BAD_PAYLOAD),
        (envelope("[1]"), BAD_PAYLOAD),
        (envelope(packet() + " x"), BAD_PAYLOAD),
        (envelope(packet(version="x")), BAD_PAYLOAD),
        (envelope(packet(source_ip={"a": 1})), BAD_PAYLOAD),
        (envelope(packet(source_port=1 << 40)), BAD_PAYLOAD),
        (envelope(packet(proto="ARP")), DOWN),
        (envelope(packet() + "\n" + packet(proto="TCP")), STORED),
        (envelope(packet() + "\nnot json"), BAD_PAYLOAD),
        (envelope(packet() + "\n" + packet(proto="ARP")), DOWN),
        (envelope('{"transaction_id":"a"\n,"proto":"b"}'), BAD_PAYLOAD),
    ],
)
def test_verdicts(spark, value, verdict):
    assert verdicts(spark, value, down=("ARP",)) == [verdict]


def test_every_class_has_its_shard(spark):
    names = {"UDP": "UDP", "TCP": "TCP", "HTTPS": "HTTPS", "TLS": "HTTPS", "ARP": "ARP", "ICMP": "OTHER"}
    routed = routing.route(messages(spark, *[envelope(packet(proto=p)) for p in names]))
    docs = routing.shard_documents(routed, F.col("msg_ts_ms")).collect()
    assert {r["proto"]: r["shard"] for r in docs} == names
    counts = {r["shard"]: r["documents"] for r in routing.shard_counts(
        routing.shard_documents(routed, F.col("msg_ts_ms"))).collect()}
    assert counts == {"UDP": 1, "TCP": 1, "HTTPS": 2, "ARP": 1, "OTHER": 1}


def test_payload_class(spark):
    values = [packet(), packet(proto=" tls "), "this is not json", None, packet(version="x")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p string")
    rows = routing.classify_payload(df, "p").orderBy("i").collect()
    assert [r["protocol"] for r in rows] == ["UDP", "HTTPS", "OTHER", "OTHER", "OTHER"]


def test_document_defaults_and_generated_ids_are_stable(spark):
    values = [envelope(packet(transaction_id=" ", client_id="")), envelope("{}")]
    routed = routing.route(messages(spark, *values))
    docs = routing.shard_documents(routed, F.col("msg_ts_ms")).orderBy("msg_offset")
    first, second = docs.collect()
    assert first["client_id"] == PACKET["source_ip"]
    assert len(first["transaction_id"]) == 64
    assert (second["version"], second["source_ip"], second["shard"]) == (0, "", "OTHER")
    assert docs.collect() == [first, second]


def test_lines_of_one_message_are_stored_apart(spark):
    blank = packet(transaction_id="")
    value = envelope(blank + "\n" + blank + "\n\nnot json\n" + packet(proto="ARP"))
    routed = routing.route(messages(spark, value), ("ARP",))
    docs = routing.shard_documents(routed, F.col("msg_ts_ms"), ("ARP",)).collect()
    assert len(docs) == 2  # the readable lines whose shard is up
    assert len({r["transaction_id"] for r in docs}) == len({r["packet_id"] for r in docs}) == 2


@pytest.mark.parametrize(
    ("attempts", "again", "dead"), [(None, 1, None), (b"1", 2, None), (b"2", None, 3), (b"abc", 1, None)]
)
def test_retry_and_dead_letter(spark, attempts, again, dead):
    value = envelope("not json")
    routed = routing.route(messages(spark, value, attempts=attempts))
    retry = routing.retry_messages(routed).collect()
    letters = routing.dead_letters(routed).collect()
    assert [r["attempts"] for r in retry] == ([] if again is None else [again])
    assert [r["attempts"] for r in letters] == ([] if dead is None else [dead])
    (sent,) = retry + letters
    assert (sent["key"], sent["value"]) == ("k0", value)
    headers = {h["key"]: bytes(h["value"]).decode() for h in sent["headers"]}
    if dead:
        assert sent["topic"] == "deadletter"
        assert headers == {"attempts": "3", "x-failure-reason": "max attempts exceeded"}
    else:
        assert sent["topic"] == "SnapshotTopic"
        assert headers == {"attempts": str(again)}


def test_settled_messages_are_not_sent_again(spark):
    routed = routing.route(messages(spark, envelope(packet()), envelope(" ")))
    assert routing.retry_messages(routed).count() == routing.dead_letters(routed).count() == 0


@pytest.mark.parametrize("bound", [100_000, 0])
def test_authentication(spark, bound):
    keys = ["valid_api_key_1", "not-a-real-key", "valid_api_key_2", None] + ["valid_api_key_1"] * 50
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "n int, key string")
    df = df.withColumn(auth.HASH, api_key_hash(F.col("key")))
    valid = auth.valid_hashes(df, ["valid_api_key_1", "valid_api_key_2"])

    def numbers(keep):
        rows = joins.in_key_set(df, valid, auth.HASH, ["n"], keep, max_broadcast=bound).collect()
        return sorted(r["n"] for r in rows)

    assert numbers(True) == [0, 2, *range(4, 54)]
    assert numbers(False) == [1, 3]
    plain = df.withColumn(auth.HASH, F.col("key"))
    assert auth.accepted(plain, valid, ["n"]).count() == 0


def test_change_feed_and_topic_pattern(spark):
    routed = routing.route(messages(spark, envelope(packet())))
    feed = routing.change_feed(routing.shard_documents(routed, F.col("msg_ts_ms")))
    row = feed.first()
    assert row["topic"] == "pcap.udp.pcap.packets"
    document = json.loads(row["value"])
    assert (document["__op"], document["storedAt"]) == ("c", 5000)
    topics = spark.createDataFrame([("pcap.udp.pcap.packets",), ("SnapshotTopic",), ("xpcap.packets",)], "topic string")
    assert [r["topic"] for r in routing.matching_topics(topics).collect()] == ["pcap.udp.pcap.packets"]
