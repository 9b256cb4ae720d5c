"""Hashes and generated identifiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(*coordinates: Column) -> Column:
    """An id made from where a row came from.

    A random id would change when a batch is replayed and defeat deduplication downstream. A null
    coordinate has a sign of its own and separators inside values are escaped, so different places
    never give the same text.
    """
    parts = [F.coalesce(_escaped(c.cast("string")), F.lit("\\N")) for c in coordinates]
    return F.sha2(F.concat_ws("|", *parts), 256)


def _escaped(text: Column) -> Column:
    marked = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(marked, F.lit("|"), F.lit("\\|"))


def hash_slot(key: Column, slots: int) -> Column:
    """A number in ``[0, slots)`` that depends on the key alone, in every engine with md5."""
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(slots).cast("bigint"))


def api_key_hash(key: Column) -> Column:
    """Lower-case hex SHA-256 of the key and one newline; the newline is part of the contract."""
    return F.sha2(F.concat(key, F.lit("\n")), 256)
