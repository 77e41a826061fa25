"""Free JSON as VARIANT: parsed once, then read by path without parsing again.

The text stays the record of what arrived. A VARIANT keeps its values, not its form: the order of keys, white
space, trailing zeros and digits beyond a decimal or double are lost.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_variant(text: Column) -> Column:
    """The parsed text; null where it is null, no JSON, or an object with a key twice."""
    return F.try_parse_json(text)


def is_unparsed(text: Column, parsed: Column) -> Column:
    """Whether there is a text that could not be parsed; never null."""
    return text.isNotNull() & parsed.isNull()


def value_at(parsed: Column, path: str, type: str) -> Column:
    """The value at a path as a type; null where there is none or it is not of that type."""
    return F.try_variant_get(parsed, path, type)


def texts_of(parsed: Column) -> Column:
    """The elements of a list as texts, without nulls; any other value gives an empty list.

    Numbers and booleans are taken as they print, objects and lists as JSON.
    """
    values = value_at(parsed, "$", "array<string>")
    return F.coalesce(F.array_compact(values), F.array().cast("array<string>"))
