"""Authentication by hashed API key; nothing passes before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetflow.functions import api_key_hash
from packetflow.operators.joins import in_key_set, literal_keys

HASH = "api_key_hash"


def valid_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The hashes of configured keys."""
    return literal_keys(df, keys, "key").select(api_key_hash(F.col("key")).alias(HASH))


def accepted(
    messages: DataFrame, valid: DataFrame, spread_by: Sequence[str], size: int | None = None
) -> DataFrame:
    """Messages whose ``api_key_hash`` is in ``valid``; ``spread_by`` identifies a message.

    ``size`` is the number of valid hashes, if known.
    """
    return in_key_set(messages, valid, HASH, spread_by, size=size)


def rejected(
    messages: DataFrame, valid: DataFrame, spread_by: Sequence[str], size: int | None = None
) -> DataFrame:
    """The other messages, those without a hash included."""
    return in_key_set(messages, valid, HASH, spread_by, keep_members=False, size=size)
