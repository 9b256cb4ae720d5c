import hashlib

import pytest
from pyspark.sql import functions as F

from packetflow import schemas
from packetflow.functions import PROTOCOLS
from packetflow.operators import projection
from packetflow.plans import fixtures
from packetflow.session import shared_dir, spread, work_dir
from packetflow.sources import batches, topics
from packetflow.sources.batches import (
    BatchTable,
    BucketedTable,
    CommitLog,
    FoldedTable,
    checkpoint_id,
)
from packetflow.sources.topics import arrival


def test_arrival_numbers_differ_between_shards_and_partitions(spark):
    rows = [
        (f"pcap.{shard.lower()}.pcap.packets", part, offset, 0, None, "v", None, None)
        for shard in PROTOCOLS for part in range(5) for offset in (0, 1, 10**9)
    ]
    rows += [(f"pcap.t{n}.pcap.packets", 1 << n % 40, 1, 0, None, "v", None, None) for n in range(300)]
    df = arrival(spark.createDataFrame(rows, schemas.TOPIC_MESSAGE))
    order = [c for c in ("arrival_seq", *projection.TIES) if c in df.columns]
    assert df.select(*order).distinct().count() == len(rows)
    assert [r["arrival_seq"] for r in df.collect()] == [r[2] for r in rows]


def test_sender_is_known_by_the_hash_in_a_header(spark):
    hashed = hashlib.sha256(b"k1\n").hexdigest()
    rows = [([("api_key", bytearray(b"k1"))],), ([("api_key_hash", bytearray(hashed.encode()))],), ([],), (None,)]
    df = spark.createDataFrame(rows, "headers array<struct<key:string,value:binary>>")
    got = df.select(topics._sender(F.col("headers")).alias("h"), topics.without_sender(F.col("headers")).alias("kept")).collect()
    assert [r["h"] for r in got] == [hashed, hashed, None, None]
    assert got[0]["kept"] == []


def test_messages_with_an_error_are_not_sent(spark):
    sent = spark.createDataFrame([("t", "k", "v", None, None), (" ", "k", "v", None, "blank topic")], schemas.TOPIC_RECORD + ", error string")
    with pytest.raises(Exception, match="(?i)kafka"):  # the connector is not part of this environment
        topics.write_kafka(sent, "localhost:1")


def test_events_are_streamed_from_a_file_or_a_folder(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows.repartition(3).write.parquet(str(tmp_path / "events.parquet"))

    def streamed(folder, name):
        out = str(tmp_path / name)
        writer = fixtures.event_stream(spark, folder).writeStream.format("parquet").trigger(availableNow=True)
        writer.option("path", out).option("checkpointLocation", out + "-cp").start().awaitTermination()
        return spark.read.parquet(out).count()

    assert streamed(sf_dir, "a") == streamed(str(tmp_path), "b") == rows.count()
    with pytest.raises(Exception, match="(?i)does not exist|FileNotFound"):
        fixtures.event_stream(spark, str(tmp_path / "nothing"))


def test_batch_table_reads_what_it_should(spark, tmp_path):
    table = BatchTable(str(tmp_path / "t"), "n BIGINT, s STRING", partition_by=("s",))
    table.create(spark)
    table.create(spark)
    assert table.read(spark).count() == 0
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n BIGINT, s STRING")
    for batch in range(3):
        table.write(df.withColumn("n", F.col("n") + 10 * batch), batch)
    table.write(df.limit(0), 2)  # a batch may come out empty when run again
    numbers = {b: sorted(r["n"] for r in f(spark, b).collect())
               for b, f in ((1, table.before), (2, table.upto), (0, table.only))}
    assert numbers == {1: [1, 2], 2: [1, 2, 11, 12], 0: [1, 2]}


def test_small_sources_are_spread_and_large_ones_left_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(10, numPartitions=1), "id").rdd.getNumPartitions() == cores
    many = spark.range(10, numPartitions=cores + 3)
    assert spread(many, "id") is many


def test_work_folders_lie_in_the_shared_one(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    assert first.startswith(shared_dir(spark))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_bucketed_table_holds_every_row_once_at_any_batch(spark, tmp_path):
    table = BucketedTable.at(str(tmp_path / "bucketed"), "n BIGINT", "n", every=2, buckets=3)
    table.create(spark)
    assert table.upto(spark, -1).count() == 0
    for batch in range(7):
        rows = spark.createDataFrame([(batch,)], "n BIGINT")
        for _ in range(2):  # written, and replayed
            table.write(rows, batch)
        assert sorted(r["n"] for r in table.upto(spark, batch).collect()) == list(range(batch + 1))
        assert sorted(r["n"] for r in table.upto(spark, batch - 1).collect()) == list(range(batch))
        assert [r["n"] for r in table.only(spark, batch).collect()] == [batch]


def test_commits_know_every_stream_and_are_kept_for_a_while(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "COMMITS_KEPT", 2)
    log = CommitLog.at(str(tmp_path))
    log.create(spark)
    state = log.state(spark)
    assert (state.last, state.written) == (-1, {})
    for number, (writer, batch) in enumerate([("a", 0), ("b", 0), ("b", 1), ("b", 2)]):
        state = log.state(spark)
        assert state.next_number(writer, batch) == number
        log.write(spark, state, writer, batch, 7)
        assert log.state(spark).next_number(writer, batch) is None
    state = log.state(spark)
    assert (state.last, state.written) == (3, {"a": 0, "b": 2})
    assert state.next_number("a", 0) is None and state.next_number("a", 1) == 4
    assert state.others("b") and state.others("c")
    assert {r["batch_id"] for r in log.table.read(spark).collect()} == {2, 3}


def test_a_checkpoint_keeps_its_id(spark, tmp_path):
    first = checkpoint_id(spark, str(tmp_path / "cp"))
    assert first == checkpoint_id(spark, str(tmp_path / "cp"))
    assert first != checkpoint_id(spark, str(tmp_path / "other"))


def test_folded_tables_delete_what_snapshots_hold(spark, tmp_path):
    table = FoldedTable.at(
        str(tmp_path / "sum"), "n BIGINT", lambda df: df.agg(F.sum("n").alias("n")), every=2
    )
    table.create(spark)
    for batch in range(9):
        table.write(spark.createDataFrame([(1,)], "n BIGINT"), batch)
        assert table.current(spark, batch).first()["n"] == batch + 1
    assert sorted(r["batch_id"] for r in table.deltas.read(spark).select("batch_id").distinct().collect()) == [7, 8]
    assert table.current(spark, 7).first()["n"] == 8
