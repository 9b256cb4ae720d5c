"""Streaming jobs: thin ``foreachBatch`` sinks over the batch operators."""

from packetflow.streaming.read_model import ReadModel
from packetflow.streaming.relay import StoredOutbox, start_relay
from packetflow.streaming.routing import Router, TargetUnreachable
from packetflow.streaming.stateful import Admission, LiveStats, SeenLedger

__all__ = [
    "Admission",
    "LiveStats",
    "ReadModel",
    "Router",
    "SeenLedger",
    "StoredOutbox",
    "TargetUnreachable",
    "start_relay",
]
