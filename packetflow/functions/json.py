"""Strict JSON objects.

``from_json`` and ``parse_json`` stop after the first value and never look at what follows, and
``from_json`` with a struct schema turns junk into a struct of nulls. Wrapping the text into an
array makes both visible: ``[`` text ``]`` yields exactly one element only if the text is one
object, with nothing behind it but white space.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Quoting the reader tolerates, on top of standard JSON.
READ_OPTIONS = {"allowSingleQuotes": "true", "allowUnquotedFieldNames": "true"}


def parse_object(text: Column, fields: str) -> Column:
    """``array<struct<fields>>`` of the wrapped text; one element if the text is one object."""
    wrapped = F.concat(F.lit("["), text, F.lit("]"))
    return F.from_json(wrapped, f"array<struct<{fields}>>", READ_OPTIONS)


def closes_itself(text: Column) -> Column:
    """True for text such as ``{..}] junk``, which closes the wrapping array on its own.

    It takes a closing bracket to do that, so only text that has one is read a second time, in a
    wrapping where a bracket right after the object is an error.
    """
    boxed = F.concat(F.lit('[{"v":'), text, F.lit("}]"))
    fails = F.from_json(boxed, "array<struct<v: variant>>", READ_OPTIONS).isNull()
    return F.when(text.contains("]"), fails).otherwise(F.lit(False))


def strict_object(text: Column, fields: str) -> Column:
    """``array<struct<fields>>`` with one element if ``text`` is exactly one object, else null."""
    parsed = parse_object(text, fields)
    return F.when((F.size(parsed) == 1) & ~closes_itself(text), parsed)


def evaluate_once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a costly column that Catalyst will not evaluate again for filters on it.

    Filters are pushed below projections by substituting the expression, which would parse each
    document once more per filter. They are not pushed below a generator.
    """
    raw = f"__{name}_value"
    valued = df.select("*", value.alias(raw))
    return valued.select("*", F.explode(F.array(raw)).alias(name)).drop(raw)


def with_object(df: DataFrame, text: Column, fields: str, name: str) -> DataFrame:
    """Add the struct column ``name`` read from ``text``; null unless it is one whole object.

    The same test as :func:`strict_object`, laid out so that the document is parsed once and all
    but the parser stays in generated code. Filters on it would still parse again: put
    :func:`evaluate_once` between.
    """
    raw, loose = f"__{name}_parsed", f"__{name}_loose"
    parsed = df.select(
        "*", parse_object(text, fields).alias(raw), closes_itself(text).alias(loose)
    )
    whole = (F.size(raw) == 1) & ~F.col(loose)
    return parsed.withColumn(name, F.when(whole, F.col(raw)[0])).drop(raw, loose)


def with_record(df: DataFrame, text: Column, fields: str, name: str) -> DataFrame:
    """:func:`with_object`, safe to filter on."""
    raw, loose = f"__{name}_parsed", f"__{name}_loose"
    parsed = df.select(
        "*", parse_object(text, fields).alias(raw), closes_itself(text).alias(loose)
    )
    whole = F.when((F.size(raw) == 1) & ~F.col(loose), F.col(raw))
    return parsed.select("*", F.explode_outer(whole).alias(name)).drop(raw, loose)


def is_nested(text: Column, fields: dict[str, Column]) -> Column:
    """True if one of the string ``fields`` read from ``text`` was an object or array there.

    Read into a string, an object looks like a string that starts with a brace. The document is
    looked at again only for rows with such a string.
    """
    braces = [f.startswith("{") | f.startswith("[") for f in fields.values()]
    suspect = reduce(lambda a, b: a | b, [F.coalesce(one, F.lit(False)) for one in braces])
    members = F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")
    typed = F.map_values(F.map_filter(members, lambda name, _: name.isin(*fields)))
    nested = F.exists(typed, lambda v: F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"))
    return F.when(suspect, F.coalesce(nested, F.lit(False))).otherwise(F.lit(False))


def bad_number(text: Column, kind: str) -> Column:
    """True if a field is given but is no integer of the type."""
    return text.isNotNull() & text.try_cast(kind).isNull()
