"""Protocol classes. A class is also the name of the shard its packets are stored in."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from packetflow.functions.text import trimmed

PROTOCOLS = ("HTTPS", "TCP", "UDP", "ARP", "OTHER")

# The names each class is known by.
CLASS_OF_NAME = {
    "HTTPS": "HTTPS",
    "TLS": "HTTPS",
    "SSL": "HTTPS",
    "TCP": "TCP",
    "UDP": "UDP",
    "ARP": "ARP",
}


def classify_protocol(proto: Column) -> Column:
    """The class of a protocol name; case and surrounding whitespace do not matter.

    Unknown, blank and missing names belong to OTHER. One map lookup, so the cleaned name is
    computed once per row instead of once per class.
    """
    names = F.create_map(*[F.lit(part) for pair in CLASS_OF_NAME.items() for part in pair])
    return F.coalesce(F.try_element_at(names, F.upper(trimmed(proto))), F.lit("OTHER"))
