"""Joins that add or test a fact per key.

``lookup`` leaves skew to AQE: both inputs come straight from a shuffle, so a hot
key on the left is split by map output and the right partition is repeated.  That
rewrite does not apply when the right side is itself an aggregate, as that needs no
shuffle of its own.  For that case ``match_salted`` spreads the left rows of a key and
repeats the narrow right rows, which are then shuffled, so that AQE can also split
whatever is still too large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every salt costs a copy of the right rows; AQE splits what four leave too large.
SALTS = 4


def lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join; ``right`` has one row per key.  No size hint: AQE broadcasts if small."""
    if left_key == right_key:
        return left.join(right, left_key, "left")
    return left.join(right, left[left_key] == right[right_key], "left").drop(right[right_key])


def match_salted(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread: Column,
    how: str,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``left`` with ``right`` (one narrow row per key) however hot a key is."""
    salted_left = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_left.join(repeated, [*on, "_salt"], how).drop("_salt")
