"""Message headers: ``array<struct<key: string, value: binary>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header names.
TIMESTAMP = "timestamp"
TYPE = "type"
ATTEMPTS = "attempts"
REASON = "x-failure-reason"


def _header(key: Column | str, value: Column) -> Column:
    name = F.lit(key) if isinstance(key, str) else key
    return F.struct(name.alias("key"), value.cast("binary").alias("value"))


def little_endian(value: Column) -> Column:
    """The eight bytes of a bigint, lowest first."""
    digits = F.lpad(F.hex(value), 16, "0")
    return F.unhex(F.concat(*[F.substring(digits, at, 2) for at in range(15, 0, -2)]))


def message_headers(ts_ms: Column, message_type: Column, metadata: Column) -> Column:
    """Time and type of a message, then each pair of its metadata map."""
    fixed = F.array(
        _header(TIMESTAMP, little_endian(ts_ms)), _header(TYPE, message_type)
    )
    pairs = F.transform(F.map_entries(metadata), lambda e: _header(e["key"], e["value"]))
    return F.when(metadata.isNull(), fixed).otherwise(F.concat(fixed, pairs))


def retry_headers(attempts: Column, reason: str | None = None) -> Column:
    """Headers of a message sent again: only the counter and, if given, the reason."""
    headers = [_header(ATTEMPTS, attempts.cast("string"))]
    if reason is not None:
        headers.append(_header(REASON, F.lit(reason)))
    return F.array(*headers)


def attempt_count(headers: Column) -> Column:
    """The last ``attempts`` header as an integer; 0 if absent or no integer."""
    last = F.try_element_at(F.filter(headers, lambda h: h["key"] == ATTEMPTS), F.lit(-1))
    return F.coalesce(last["value"].cast("string").try_cast("int"), F.lit(0))
