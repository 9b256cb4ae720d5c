"""Where rows come from and go to."""

from packetflow.sources.batches import BatchTable, BucketedTable, CommitLog, FoldedTable
from packetflow.sources.shards import MergedShards, read_shards, shard_change_stream
from packetflow.sources.topics import file_topic, kafka_pattern, kafka_topic, write_kafka

__all__ = [
    "BatchTable",
    "BucketedTable",
    "CommitLog",
    "FoldedTable",
    "MergedShards",
    "file_topic",
    "kafka_pattern",
    "kafka_topic",
    "read_shards",
    "shard_change_stream",
    "write_kafka",
]
