"""The several forms a storage time may have in a change event."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last millisecond of the years 1 to 9999.
MIN_EPOCH_MS = -62135596800000
MAX_EPOCH_MS = 253402300799999

#: A full date, optionally a time, optionally an offset. Spark's cast alone would also read
#: bare years and bare times, the latter as times of today.
ISO_TIME = (
    r"^\s*\d{4}-\d{1,2}-\d{1,2}"
    r"([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?\s*(Z|[+-]\d{1,2}:\d{2})?)?\s*$"
)


def is_iso_time(text: Column) -> Column:
    return text.rlike(ISO_TIME)


def stored_at(field: Column) -> Column:
    """Timestamp of a VARIANT field: an integer is epoch milliseconds, a string an ISO time.

    A string without an offset is UTC, so the session time zone must be. Anything unusable is
    null. A quoted number is a string, hence no time.
    """
    kind = F.schema_of_variant(field)
    millis = F.try_variant_get(field, "$", "bigint")
    text = F.try_variant_get(field, "$", "string")
    return F.when(
        (kind == "BIGINT") & millis.between(MIN_EPOCH_MS, MAX_EPOCH_MS), F.timestamp_millis(millis)
    ).when((kind == "STRING") & is_iso_time(text), text.try_cast("timestamp"))


def stored_at_usable(field: Column) -> Column:
    """False for values that are an error rather than a missing time.

    These are objects, arrays and integers no calendar date stands for.
    """
    kind = F.schema_of_variant(field)
    millis = F.try_variant_get(field, "$", "bigint")
    return (
        F.when(kind == "BIGINT", millis.between(MIN_EPOCH_MS, MAX_EPOCH_MS))
        .when(kind.rlike("^(OBJECT|ARRAY)"), F.lit(False))
        .when(kind.rlike(r"^DECIMAL\((19|[23]\d),0\)$"), F.lit(False))
        .otherwise(F.lit(True))
    )
