"""The current copy of each record of a landing, which holds every delivery.

What is out of date is found from the key and the order of arrival alone; the wide rows
then only lose those few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.lookup import match_salted

LAST = "_last"


def superseded(rows: DataFrame, key: str, ord: str) -> DataFrame:
    """(key, ord) of the copies of which a later one of the same key arrived."""
    narrow = rows.select(F.col(key).alias(key), F.col(ord).alias(ord))
    last = narrow.groupBy(key).agg(F.max(ord).alias(LAST), F.count("*").alias("_n"))
    repeated = last.filter(F.col("_n") > 1).drop("_n")
    copies = match_salted(narrow, repeated, [key], F.col(ord), "inner")
    return copies.filter(F.col(ord) < F.col(LAST)).select(key, ord)


def current(rows: DataFrame, key: str, ord: str) -> DataFrame:
    """The last copy of each key; ``ord`` is unique within one.  Rows without a key all stay.

    Reads its input twice: once key and order alone, for the keys that have several copies.
    """
    last = rows.groupBy(F.col(key).alias(key)).agg(F.max(ord).alias(LAST), F.count("*").alias("_n"))
    repeated = last.filter((F.col("_n") > 1) & F.col(key).isNotNull()).drop("_n")
    found = match_salted(rows, repeated, [key], F.col(ord), "left")
    return found.filter(F.col(LAST).isNull() | (F.col(ord) == F.col(LAST))).select(*rows.columns)


def one_per_key(rows: DataFrame, key: str, ord: str) -> DataFrame:
    """The last copy of each key to arrive, without ``ord``; rows without a key are dropped."""
    return current(rows.filter(F.col(key).isNotNull()), key, ord).drop(ord)
