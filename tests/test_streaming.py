"""Streams over several micro-batches: redelivery, replay, failure, recovery."""

import glob
import hashlib
import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from packetflow import schemas
from packetflow.operators import outbox
from packetflow.plans import queries
from packetflow.session import bare_settings, short_batches
from packetflow.sources.batches import BucketedTable, FoldedTable
from packetflow.sources.shards import MergedShards, read_shards, shard_change_stream
from packetflow.sources.topics import file_topic
from packetflow.streaming import read_model
from packetflow.streaming.read_model import ReadModel
from packetflow.operators.joins import without_stored
from packetflow.streaming.relay import StoredOutbox, published_table, read_published, start_relay
from packetflow.streaming.routing import Router, TargetUnreachable

HASH = hashlib.sha256(b"valid_api_key_1\n").hexdigest()
FEED = schemas.CHANGE_EVENT + ", processed_ms BIGINT"


def event(tx, client="c1", version=1, proto="TCP", stored=1000, op="c"):
    return json.dumps(
        {"__op": op, "transaction_id": tx, "client_id": client, "version": version,
         "proto": proto, "storedAt": stored}
    )


def feed(spark, first, *values, clock=None):
    rows = [(first + i, first + i, "T", 0, v, clock or first + i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, FEED)


def ledger(model, spark):
    return {r["transaction_id"]: r["proto"] for r in model.read_ledger(spark).collect()}


def states(model, spark):
    return {r["client_id"]: (r["version"], r["last_proto"]) for r in model.read_client_state(spark).collect()}


def counts(model, spark):
    return {r["proto"]: r["packet_count"] for r in model.read_stats(spark).collect()}


@pytest.fixture
def model(spark, tmp_path):
    made = ReadModel(
        str(tmp_path / "model"), ttl_ms=1000, snapshot_every=3, ledger_buckets=4, ledger_every=3
    )
    made.create(spark)
    return made


def test_redelivery_across_batches_is_absorbed(spark, model):
    model.project(feed(spark, 0, event("a"), event("b"), event("a", proto="DNS")), 0)
    model.project(feed(spark, 10, event("a", proto="DNS", version=9), event("d", proto="UDP")), 1)
    assert ledger(model, spark) == {"a": "TCP", "b": "TCP", "d": "UDP"}
    assert counts(model, spark) == {"TCP": 2, "UDP": 1}
    # The marker stopped the redelivery, so its version did not reach the state.
    assert states(model, spark) == {"c1": (1, "TCP")}


def test_replay_of_any_batch_changes_nothing(spark, model):
    batches = [
        feed(spark, 0, event("a"), event("b", version=5, proto="UDP")),
        feed(spark, 10, event("a"), event("d", version=3)),
        feed(spark, 20, event("e", version=7, proto="ARP"), None, "{"),
        feed(spark, 30, event("f", version=6, client="c2")),
    ]
    for number, batch in enumerate(batches):
        model.project(batch, number)
        before = ledger(model, spark), states(model, spark), counts(model, spark)
        model.project(batch, number)
        assert (ledger(model, spark), states(model, spark), counts(model, spark)) == before
    assert set(ledger(model, spark)) == {"a", "b", "d", "e", "f"}
    assert states(model, spark) == {"c1": (7, "ARP"), "c2": (6, "TCP")}


def test_crash_before_the_commit_shows_nothing_and_heals(spark, model, monkeypatch):
    model.project(feed(spark, 0, event("a")), 0)
    batch = feed(spark, 10, event("b", version=2), event("d", version=3))
    stats_type = type(model.stats)

    def fail(*_, **__):
        raise RuntimeError("executor gone")

    with monkeypatch.context() as patch:
        patch.setattr(stats_type, "write", fail)  # after the ledger, before state and markers
        with pytest.raises(RuntimeError):
            model.project(batch, 1)
    assert set(ledger(model, spark)) == {"a"}
    model.project(batch, 1)
    assert set(ledger(model, spark)) == {"a", "b", "d"}
    assert counts(model, spark) == {"TCP": 3}
    assert states(model, spark) == {"c1": (3, "TCP")}


def test_expired_markers_fall_back_to_the_ledger(spark, model):
    model.project(feed(spark, 0, event("a")), 0)
    model.project(feed(spark, 10, event("a", version=9, proto="DNS"), clock=5000), 1)
    assert ledger(model, spark) == {"a": "TCP"}
    assert counts(model, spark) == {"TCP": 1}
    assert states(model, spark) == {"c1": (9, "DNS")}  # a duplicate still moves the state


def test_snapshots_fold_and_forget_expired_markers(spark, model):
    for number in range(8):
        clock = 100_000 * (number + 1)
        model.project(feed(spark, number * 10, event(f"t{number}", version=number), clock=clock), number)
    assert states(model, spark) == {"c1": (7, "TCP")}
    assert counts(model, spark) == {"TCP": 8}
    assert len(ledger(model, spark)) == 8
    kept = model.markers.snapshots.only(spark, 6).collect()
    assert [r["transaction_id"] for r in kept] == ["t6"]


def test_folded_table_reads_only_snapshot_and_later_deltas(spark, tmp_path):
    table = FoldedTable.at(
        str(tmp_path / "sum"), "n BIGINT", lambda df: df.agg(F.sum("n").alias("n")), every=2
    )
    table.create(spark)
    for batch in range(6):
        table.write(spark.createDataFrame([(1,)], "n BIGINT"), batch)
        assert table.current(spark, batch).first()["n"] == batch + 1
    table.deltas.write(spark.createDataFrame([(100,)], "n BIGINT"), 1)  # behind the snapshot
    assert table.current(spark, 5).first()["n"] == 6


def test_wrong_types_go_to_quarantine(spark, model):
    model.project(feed(spark, 0, '{"transaction_id":"a","version":"x"}', event("b")), 0)
    rows = model.quarantine.read(spark).collect()
    assert [(r["arrival_seq"], r["skip_reason"]) for r in rows] == [(0, "bad_type")]
    assert set(ledger(model, spark)) == {"b"}


def write_files(spark, path, frames):
    for number, frame in enumerate(frames):
        frame.coalesce(1).write.parquet(f"{path}/part={number}")


def test_stream_of_many_files_with_a_restart(spark, model, tmp_path):
    source, checkpoint = str(tmp_path / "feed"), str(tmp_path / "checkpoint")
    frames = [feed(spark, 10 * i, event("a", version=i), event(f"t{i}", version=i)) for i in range(4)]
    write_files(spark, source, frames[:2])
    model.start(file_topic(spark, source, FEED, max_files=1), checkpoint).awaitTermination()
    assert model.commits.last(spark) == 1
    write_files(spark, source + "/later", frames[2:])
    model.start(file_topic(spark, source, FEED, max_files=1), checkpoint).awaitTermination()
    assert set(ledger(model, spark)) == {"a", "t0", "t1", "t2", "t3"}
    assert counts(model, spark) == {"TCP": 5}


def packet(proto="UDP", tx="tx-1"):
    body = {"transaction_id": tx, "client_id": "c1", "version": 1, "proto": proto, "source_ip": "i"}
    return json.dumps({"Topic": "SnapshotTopic", "Payload": json.dumps(body)})


def topic(spark, *values, key="valid_api_key_1"):
    sender = hashlib.sha256(f"{key}\n".encode()).hexdigest()
    rows = [("SnapshotTopic", 0, i, 5000 + i, f"k{i}", v, None, sender) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, schemas.TOPIC_MESSAGE)


def test_unreachable_store_replays_the_batch_without_counting(spark, tmp_path):
    source, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    topic(spark, packet(), "{ bad").write.parquet(source)
    down = Router(str(tmp_path / "sink"), allow_anyone=True, reachable=lambda: False)
    with pytest.raises(StreamingQueryException, match="was not delivered"):
        down.start(file_topic(spark, source), checkpoint).awaitTermination()
    with pytest.raises(TargetUnreachable):
        down.route(topic(spark, packet()), 0)
    up = Router(str(tmp_path / "sink"), allow_anyone=True)
    up.start(file_topic(spark, source), checkpoint).awaitTermination()
    assert up.shards.read(spark).count() == 1
    assert [r["attempts"] for r in up.retries.read(spark).collect()] == [1]


def test_routing_replay_and_refused_senders(spark, tmp_path):
    router = Router(str(tmp_path / "sink"), valid_keys=["valid_api_key_1"], down_shards=("ARP",))
    router.create(spark)
    good = topic(spark, packet(), packet("ARP"), "{ bad", packet("TCP"))
    batch = good.unionByName(topic(spark, packet(), key="wrong").withColumn("msg_partition", F.lit(1)))
    for _ in range(2):
        router.route(batch, 0)
        shards = {r["shard"]: r["count"] for r in router.shards.read(spark).groupBy("shard").count().collect()}
        assert shards == {"UDP": 1, "TCP": 1}
        assert router.retries.read(spark).count() == 2
        assert router.refused.read(spark).count() == 1
    only = read_shards(spark, router.shards.path, ["TCP"])
    assert [r["proto"] for r in only.collect()] == ["TCP"]


def test_retries_end_in_dead_letters_after_three_tries(spark, tmp_path):
    source, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    router = Router(str(tmp_path / "sink"), retry_path=f"{source}/retries", allow_anyone=True)
    topic(spark, packet(), "{ bad").write.parquet(f"{source}/first")
    tries = []
    for _ in range(4):
        router.start(file_topic(spark, source), checkpoint).awaitTermination()
        tries.append(router.dead_letters.read(spark).count())
    assert tries == [0, 0, 1, 1]
    assert router.dead_letters.read(spark).first()["attempts"] == 3
    assert router.shards.read(spark).count() == 1


def test_shards_feed_the_read_model(spark, model, tmp_path):
    router = Router(str(tmp_path / "sink"), allow_anyone=True)
    router.create(spark)
    router.route(topic(spark, packet("TLS", "a"), packet("udp", "b"), packet("tcp", "b")), 0)
    for batch in (1, 2):
        stream = shard_change_stream(spark, router.shards.path)
        model.start(stream, str(tmp_path / "cdc")).awaitTermination()
        # the order of the messages is that of the events: the first b stays
        assert ledger(model, spark) == {"a": "TLS", "b": "udp", **({"d": "arp"} if batch == 2 else {})}
        router.route(topic(spark, packet("ARP", "a"), packet("arp", "d")), 1)
    assert counts(model, spark) == {"TLS": 1, "udp": 1, "arp": 1}


def test_version_ties_go_to_the_earlier_batch_whatever_the_offsets(spark, model):
    model.project(feed(spark, 1000, event("a", version=5, proto="TCP")), 0)
    for number in range(1, 5):  # before and behind a snapshot
        model.project(feed(spark, 5 * number, event(f"b{number}", version=5, proto="UDP")), number)
        assert states(model, spark) == {"c1": (5, "TCP")}


def test_new_checkpoint_on_filled_tables_changes_nothing(spark, model, tmp_path):
    source = str(tmp_path / "feed")
    write_files(spark, source, [feed(spark, 10 * i, event("a", version=i), event(f"t{i}", version=i)) for i in range(3)])
    for checkpoint in ("one", "two"):
        stream = file_topic(spark, source, FEED, max_files=1)
        model.start(stream, str(tmp_path / checkpoint)).awaitTermination()
        assert sorted(r["transaction_id"] for r in model.read_ledger(spark).collect()) == ["a", "t0", "t1", "t2"]
        assert counts(model, spark) == {"TCP": 4}
    assert model.commits.last(spark) == 5
    model.project(feed(spark, 0, event("x"), event("a", proto="DNS")), 0)  # by yet another writer
    assert ledger(model, spark)["a"] == "TCP" and "x" in ledger(model, spark)
    assert counts(model, spark) == {"TCP": 5}


def test_nobody_is_let_in_by_default(spark, tmp_path):
    router = Router(str(tmp_path / "sink"))
    router.create(spark)
    router.route(topic(spark, packet(), packet("TCP", "b")), 0)
    assert router.shards.read(spark).count() == 0
    assert router.refused.read(spark).count() == 2


def test_hashes_of_a_table_let_senders_in(spark, tmp_path):
    known = topic(spark, packet()).select("api_key_hash").distinct()
    router = Router(str(tmp_path / "sink"), valid_hashes=known)
    router.create(spark)
    router.route(topic(spark, packet()).unionByName(topic(spark, packet("TCP", "b"), key="other")), 0)
    assert [r["shard"] for r in router.shards.read(spark).collect()] == ["UDP"]
    assert router.refused.read(spark).count() == 1


def test_relay_stream_publishes_each_row_once(spark, tmp_path):
    source = str(tmp_path / "outbox")

    def rows(ids):
        df = spark.createDataFrame([(i,) for i in ids], "id STRING")
        return outbox.outbox_rows(df, "T", F.lit(1), fields=["id"])

    rows(["a", "b"]).write.mode("append").parquet(source)
    for extra in (["c"], []):
        stream = spark.readStream.schema(schemas.OUTBOX).parquet(source)
        start_relay(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        if extra:
            rows(extra).write.mode("append").parquet(source)
    sent = published_table(str(tmp_path / "out")).read(spark)
    payloads = sorted(json.loads(r["value"])["Payload"] for r in sent.collect())
    assert payloads == ['{"id":"a"}', '{"id":"b"}', '{"id":"c"}']


def test_retries_and_dead_letters_are_published_where_a_topic_is_given(spark, tmp_path):
    sent = []
    router = Router(str(tmp_path / "sink"), allow_anyone=True, max_attempts=2, publish=lambda m: sent.extend(m.collect()))
    router.create(spark)
    tried = [("attempts", bytearray(b"1"))]
    batch = topic(spark, "{ bad", packet()).unionByName(
        spark.createDataFrame([("SnapshotTopic", 0, 9, 1, "k9", "{ bad", tried, None)], schemas.TOPIC_MESSAGE)
    )
    router.route(batch, 0)
    assert sorted((r["topic"], r["key"], [h["key"] for h in r["headers"]]) for r in sent) == [
        ("SnapshotTopic", "k0", ["attempts", "api_key_hash"]),
        ("deadletter", "k9", ["attempts", "x-failure-reason"]),
    ]
    assert router.retries.read(spark).count() == router.dead_letters.read(spark).count() == 0


def test_a_small_batch_writes_few_files(spark, tmp_path):
    router = Router(str(tmp_path / "sink"), allow_anyone=True)
    router.create(spark)
    kinds = ["UDP", "TCP", "ARP", "TLS", "x"]
    router.route(topic(spark, *[packet(kinds[i % 5], f"t{i}") for i in range(100)]).repartition(16), 0)
    assert len(list((tmp_path / "sink" / "shards").rglob("*.parquet"))) == 5


def by_turns(checkpoints, run):
    for turn, checkpoint in enumerate(checkpoints):
        run(turn, checkpoint)


def test_checkpoints_that_take_turns_lose_nothing(spark, model, tmp_path):
    source = {name: str(tmp_path / f"feed-{name}") for name in "AB"}

    def run(turn, name):
        first = 100 * turn
        frame = feed(spark, first, event(f"{name}{turn}"), event("both"), event(f"{name}{turn}", proto="DNS"))
        frame.write.mode("append").parquet(source[name])
        stream = file_topic(spark, source[name], FEED)
        model.start(stream, str(tmp_path / f"cp-{name}")).awaitTermination()

    by_turns("ABABA", run)
    wanted = {"both", *(f"{n}{t}" for t, n in enumerate("ABABA"))}
    assert set(ledger(model, spark)) == wanted
    assert counts(model, spark) == {"TCP": len(wanted)}


def test_a_batch_delivered_again_after_others_wrote_changes_nothing(spark, model):
    model.project(feed(spark, 0, event("a")), 0, "one")
    model.project(feed(spark, 0, event("b")), 0, "two")
    model.project(feed(spark, 0, event("a"), event("late")), 0, "one")  # is finished
    assert set(ledger(model, spark)) == {"a", "b"}
    model.project(feed(spark, 0, event("d")), 1, "one")
    assert set(ledger(model, spark)) == {"a", "b", "d"}


def test_a_router_with_a_second_checkpoint_keeps_and_repeats_nothing(spark, tmp_path):
    source = str(tmp_path / "topic")
    router = Router(str(tmp_path / "sink"), valid_keys=["valid_api_key_1"], down_shards=("ARP",), max_attempts=2)
    strange = topic(spark, packet(), key="wrong").withColumn("msg_partition", F.lit(1))
    tried = [("SnapshotTopic", 0, 9, 1, "k9", "{ bad", [("attempts", bytearray(b"1"))], HASH)]
    again = spark.createDataFrame(tried, schemas.TOPIC_MESSAGE)
    topic(spark, packet(), packet("ARP"), "{ bad", packet("TCP", "t")).unionByName(strange).unionByName(again).write.parquet(source)
    other = str(tmp_path / "other")
    topic(spark, packet("TLS", "o")).withColumn("msg_offset", F.lit(77).cast("long")).write.parquet(other)

    def rows():
        tables = (router.shards, router.retries, router.dead_letters, router.refused)
        return [sorted(str(r[:-1]) for r in router.stored(spark, t).drop("batch_id").collect()) for t in tables]

    router.start(file_topic(spark, source), str(tmp_path / "one")).awaitTermination()
    first = rows()
    assert [len(x) for x in first] == [2, 2, 1, 1]
    router.start(file_topic(spark, other), str(tmp_path / "two")).awaitTermination()
    assert [len(x) for x in rows()] == [3, 2, 1, 1] and set(first[0]) < set(rows()[0])
    for checkpoint in ("three", "one", "three"):  # read from the first message again
        router.start(file_topic(spark, source), str(tmp_path / checkpoint)).awaitTermination()
        assert [len(x) for x in rows()] == [3, 2, 1, 1]


def test_a_relay_with_a_second_checkpoint_keeps_and_repeats_nothing(spark, tmp_path):
    def rows(ids):
        df = spark.createDataFrame([(i,) for i in ids], "id STRING")
        return outbox.outbox_rows(df, "T", F.lit(1), fields=["id"])

    source, out = str(tmp_path / "outbox"), str(tmp_path / "out")
    rows("abc").write.mode("append").parquet(source)
    sent = []
    for turn, checkpoint in enumerate(("one", "two", "one", "two")):
        stream = spark.readStream.schema(schemas.OUTBOX).parquet(source)
        start_relay(stream, out, str(tmp_path / checkpoint)).awaitTermination()
        values = [json.loads(r["value"])["Payload"] for r in read_published(spark, out).collect()]
        assert len(values) == len(set(values))
        sent.append(len(values))
        rows([f"new{turn}"]).write.mode("append").parquet(source)
    assert sent == [3, 4, 5, 6]


@pytest.mark.parametrize("size", [10, 10_000_000])
def test_a_bucketed_ledger_is_not_shuffled(spark, tmp_path, size, request):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a ledger of any size
    table = BucketedTable.at(str(tmp_path / "t"), "key STRING, n BIGINT", "key", every=1, buckets=4)
    table.create(spark)
    for number in range(3):
        rows = spark.range(100).select(F.concat(F.lit(f"{number}-"), "id").alias("key"), F.col("id").alias("n"))
        table.write(rows, number)
    stored, deltas = table.parts(spark, 2)
    assert deltas.count() == 0 and stored.count() == 300
    batch = spark.createDataFrame([("0-1",), ("x",), ("2-99",)], "key STRING").repartition(3)
    left = without_stored(batch, stored, "key", size)
    text = left._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    # only the batch is dealt out anew
    assert text.count("hashpartitioning") == 1 and "Bucketed: true" in text
    assert size > 10 or "PushedFilters: [In(key" in text
    assert [r["key"] for r in left.collect()] == ["x"]
    # a session that has never seen the table learns of it from the folder
    spark.sql(f"DROP TABLE {table._place(2)[0]}")
    assert {r["key"] for r in without_stored(batch, table.upto(spark, 2), "key", 3).collect()} == {"x"}


def test_an_outbox_with_workers_takes_rows_added_later(spark, tmp_path):
    stored = StoredOutbox(str(tmp_path / "outbox"), snapshot_every=2, workers=3)

    def rows(ids):
        df = spark.createDataFrame([(f"r{i}",) for i in ids], "id STRING")
        return outbox.outbox_rows(df, "T", F.lit(1), fields=["id"])

    stored.load(rows(range(10)))
    sent = []

    def send(messages):
        sent.extend(r["id"] for r in messages.collect())

    def down(messages):
        raise ConnectionError

    for number in range(4):
        for worker in range(3):
            if (number, worker) == (1, 2):
                with pytest.raises(ConnectionError):
                    stored.tick(spark, number, 1000, down, limit=2, worker=worker)
            else:
                stored.tick(spark, number, 1000 + 30_000 * number, send, limit=4, worker=worker)
            stored.tick(spark, number, 0, send, worker=worker)  # is finished
        stored.append(rows(range(10 + 3 * number, 13 + 3 * number)), "w", number)
        stored.append(rows(range(90, 99)), "w", number)  # was added
    for worker in range(3):
        stored.tick(spark, 4, 900_000, send, worker=worker)
    assert len(sent) == len(set(sent)) == 22
    left = stored.read(spark).filter("is_processed = 0")
    assert left.count() == 0
    with pytest.raises(ValueError, match="comes after"):
        stored.tick(spark, 9, 0, send)


def test_merged_shards_are_few_files_and_come_once(spark, tmp_path):
    router = Router(str(tmp_path / "sink"), allow_anyone=True)
    router.create(spark)
    store = MergedShards(router.shards.path, rows_per_file=10)
    events = str(tmp_path / "events")
    kinds = ["UDP", "TCP", "TLS"]
    for batch in range(6):
        rows = topic(spark, *[packet(kinds[i % 3], f"t{batch}-{i}") for i in range(12)])
        router.route(rows.withColumn("msg_offset", F.col("msg_offset") + 100 * batch), batch)
        feed = shard_change_stream(spark, router.shards.path).select("value")
        sink = feed.writeStream.format("parquet").option("path", events)
        sink = sink.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
        sink.start().awaitTermination()
        if batch % 2:
            for _ in range(2):  # a second call has nothing to do
                store.merge(spark, batch)
        read = store.read(spark, batch)
        assert read.count() == read.select("packet_id").distinct().count() == 12 * (batch + 1)
    assert spark.read.schema("value STRING").parquet(events).distinct().count() == 72
    assert spark.read.schema("value STRING").parquet(events).count() == 72
    assert store.read(spark, 5, ["UDP"]).count() == 24
    left = sorted(p.name for p in (tmp_path / "sink" / "shards").iterdir() if "batch_id" in p.name)
    assert left == ["batch_id=4", "batch_id=5"]  # of the last merge
    files = list((tmp_path / "sink" / "shards-merged").rglob("*.parquet"))
    assert {p.parent.parent.name for p in files} == {"shard=UDP", "shard=TCP", "shard=HTTPS"}
    assert len(files) <= 3 * 3 * 2


def test_parts_of_a_topic_are_shared_by_readers(spark, tmp_path, monkeypatch):
    ids = [None, None, *range(-25, 600)]
    rows = spark.createDataFrame([(i,) for i in ids], "event_id BIGINT").selectExpr(
        "event_id", "timestamp_ntz '2024-01-15 00:00:00' AS ts", "event_id AS user_id",
        "'view' AS event_type", "1.0D AS value", "'' AS props",
    )
    rows.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(queries.fx, "PART_MESSAGES", 25)
    monkeypatch.setattr(queries, "work_dir", lambda spark, name: str(tmp_path / name))
    found = {tuple(r) for r in queries.QUERIES["stream_bounded"](spark, str(tmp_path)).collect()}
    assert found == {(None, 2, 1, 2)} | {(part, 25, 1, 25) for part in range(-1, 24)}
    commits = glob.glob(f"{tmp_path}/bounded/**/commits/*", recursive=True)
    batches = Counter(os.path.dirname(commit) for commit in commits)
    assert sum(batches.values()) == 26
    assert max(batches.values()) == 3  # parts 0, 16 and those without a number


def test_a_bounded_batch_writes_one_file_in_no_folder_of_its_own(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).selectExpr(
        "id AS event_id", "timestamp_ntz '2024-01-15 00:00:00' AS ts", "id AS user_id",
        "'view' AS event_type", "1.0D AS value", "'' AS props",
    )
    rows.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(queries.fx, "PART_MESSAGES", 25)
    monkeypatch.setattr(queries, "work_dir", lambda spark, name: str(tmp_path / name))
    found = {tuple(r) for r in queries.QUERIES["stream_bounded"](spark, str(tmp_path)).collect()}
    assert found == {(part, 25, 1, 25) for part in range(40)}
    written = glob.glob(f"{tmp_path}/bounded/**/*.parquet", recursive=True)
    folders = Counter(os.path.dirname(f) for f in written if "/topic/" not in f)
    assert sum(folders.values()) == 40 and len(folders) == 16


def test_streams_of_short_batches_list_folders_with_few_tasks(spark, tmp_path):
    spark.range(50).selectExpr("id", "id AS part").write.partitionBy("part").parquet(str(tmp_path / "t"))
    session, sc = short_batches(spark, str(tmp_path)), spark.sparkContext
    sc.setJobGroup("listing", "folders")
    try:
        rows = session.read.schema("id BIGINT, part BIGINT").parquet(str(tmp_path / "t"))
        jobs = sc.statusTracker().getJobIdsForGroup("listing")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
    assert [sc.statusTracker().getStageInfo(s).numTasks for s in stages] == [sc.defaultParallelism]
    assert rows.count() == 50
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    assert session.conf.get(name) != spark.conf.get(name, None)  # the caller's session is left alone


@pytest.mark.parametrize("most", [0, 3, 100_000])
def test_records_of_a_large_batch_are_kept_once_and_uncompressed(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(read_model, "MAX_BROADCAST_KEYS", most)
    name = "spark.sql.inMemoryColumnarStorage.compressed"
    seen, known = [], read_model.projection.fast_path

    def fast_path(firsts, *rest):
        seen.append((firsts.storageLevel.useMemory, spark.conf.get(name)))
        return known(firsts, *rest)

    monkeypatch.setattr(read_model.projection, "fast_path", fast_path)
    model = ReadModel(str(tmp_path / "model"), ledger_every=2, ledger_buckets=2)
    model.create(spark)
    bad = event("bad", stored={"a": 1})
    first = [event("a"), event("b", proto="UDP"), event("a", proto="DNS"), event("c"), bad, "{", event("d")]
    model.project(feed(spark, 0, *first, clock=7), 0)
    model.project(feed(spark, 100, event("b"), event("e"), event("e"), event("f"), event("g"), clock=9), 1)
    model.project(feed(spark, 200, event("b"), event("h"), clock=9), 2)
    assert ledger(model, spark) == {"b": "UDP"} | dict.fromkeys("acdefgh", "TCP")
    told = {(r["batch_id"], r["outcome"]): r["events"] for r in model.read_outcomes(spark).collect()}
    assert told == {
        (0, "Skipped"): 2, (0, "Projected"): 4, (0, "FastPathSkip"): 1, (1, "Projected"): 3,
        (1, "FastPathSkip"): 2, (2, "Projected"): 1, (2, "FastPathSkip"): 1,
    }
    assert model.quarantine.read(spark).count() == 1
    assert [r["rows"] for r in model.commits.table.read(spark).orderBy("batch_id").collect()] == [4, 4, 2]
    assert seen == [(most == 100_000 or (most == 3 and n == 2), "false") for n in range(3)]
    assert spark.conf.get(name) == "true"


def test_bounded_batches_share_compiled_code_and_write_plain_files(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).selectExpr(
        "id AS event_id", "timestamp_ntz '2024-01-15 00:00:00' AS ts", "id AS user_id",
        "'view' AS event_type", "1.0D AS value", "'' AS props",
    )
    rows.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(queries.fx, "PART_MESSAGES", 25)
    monkeypatch.setattr(queries, "DEALT_MESSAGES", 50, raising=False)
    monkeypatch.setattr(queries, "work_dir", lambda spark, name: str(tmp_path / name))
    compiled = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME()
    before = compiled.getCount()
    result = queries.QUERIES["stream_bounded"](spark, str(tmp_path))
    assert compiled.getCount() - before < 40  # micro-batches
    assert {tuple(r) for r in result.collect()} == {(part, 25, 1, 25) for part in range(40)}
    written = [p.name for p in (tmp_path / "bounded").rglob("*") if p.is_file()]
    assert not [name for name in written if name.endswith(".crc")]
    topic = (tmp_path / "bounded" / "topic").rglob("*.parquet")
    assert len({p.name.split("-")[1] for p in topic}) > 4  # tasks that dealt the messages out


def test_settings_are_sent_without_their_sources_and_keep_them(spark):
    settings, java = spark._jsc.hadoopConfiguration(), spark._jvm.java.io

    def sent() -> int:
        copy = spark._jsparkSession.sessionState().newHadoopConf()
        out = java.ByteArrayOutputStream()
        copy.write(java.DataOutputStream(out))
        return out.size()

    usual, sources = sent(), list(settings.getPropertySources("io.file.buffer.size"))
    with pytest.raises(ConnectionError), bare_settings(spark):
        assert settings.get("io.file.buffer.size") and sent() < usual * 0.8
        raise ConnectionError
    assert sent() == usual
    assert list(settings.getPropertySources("io.file.buffer.size")) == sources


def test_logs_of_short_batches_do_not_grow_with_their_number(spark, tmp_path):
    rows = spark.range(80).selectExpr("id", "id AS part").repartition(4, "part")
    rows.write.partitionBy("part").parquet(str(tmp_path / "t"))
    session = short_batches(spark, str(tmp_path))
    topic = session.readStream.schema("id BIGINT, part BIGINT").option("maxFilesPerTrigger", 1)
    sink = topic.parquet(str(tmp_path / "t")).writeStream.format("parquet")
    sink = sink.option("path", str(tmp_path / "rows")).trigger(availableNow=True)
    sink.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination()
    stored = spark.read.schema("id BIGINT").parquet(str(tmp_path / "rows"))
    assert stored.distinct().count() == stored.count() == 80
    for logs in ("cp/sources/0", "cp/offsets", "cp/commits", "rows/_spark_metadata"):
        assert 2 <= len(list((tmp_path / logs).iterdir())) < 60, logs
