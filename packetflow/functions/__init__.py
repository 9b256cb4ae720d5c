"""Column functions; all of them are compositions of Spark built-ins."""

from packetflow.functions.headers import attempt_count, message_headers, retry_headers
from packetflow.functions.ids import api_key_hash, hash_slot, stable_id
from packetflow.functions.json import (
    evaluate_once,
    parse_object,
    strict_object,
    with_object,
    with_record,
)
from packetflow.functions.protocol import PROTOCOLS, classify_protocol
from packetflow.functions.text import is_blank, split_lines, trimmed
from packetflow.functions.times import is_iso_time, stored_at, stored_at_usable

__all__ = [
    "PROTOCOLS",
    "api_key_hash",
    "attempt_count",
    "classify_protocol",
    "evaluate_once",
    "hash_slot",
    "is_blank",
    "is_iso_time",
    "message_headers",
    "parse_object",
    "retry_headers",
    "split_lines",
    "stable_id",
    "stored_at",
    "stored_at_usable",
    "strict_object",
    "trimmed",
    "with_object",
    "with_record",
]
