"""Whitespace as Unicode defines it: Spark's own trim removes spaces only."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# The characters Unicode calls white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(text: Column) -> Column:
    """Text without leading and trailing whitespace, tabs and newlines included.

    Looks at the ends of the text only, which a regular expression does not.
    """
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return text.isNull() | (trimmed(text) == "")


def split_lines(text: Column) -> Column:
    """The trimmed, non-empty lines of a newline-batched payload.

    Text of one line needs no lambda, which Spark would interpret.
    """
    whole = trimmed(text)
    one_line = F.when(whole == "", F.array().cast("array<string>")).otherwise(F.array(whole))
    return F.when(~text.contains("\n"), one_line).otherwise(_several_lines(text))


def _several_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), trimmed), lambda line: line != "")
