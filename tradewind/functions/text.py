"""Attribute lookup and empty-text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(x: Column) -> Column:
    """The empty string counts as missing."""
    return F.nullif(x, F.lit(""))


def get_attr(attributes: Column, key: str) -> Column:
    """Value of the *first* attribute named ``key``: its name, else its id.

    If that first match carries no value the answer is null; later matches
    are not consulted.
    """
    first = F.get(F.filter(attributes, lambda a: a["id"] == key), F.lit(0))
    return F.coalesce(blank_to_null(first["value_name"]), blank_to_null(first["value_id"]))


def id_or_null(x: Column) -> Column:
    """Text of an id; empty and zero ids count as missing."""
    return F.nullif(blank_to_null(x), F.lit("0"))
