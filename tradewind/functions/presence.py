"""Which fields a document has: an absent one is not the same as one that is null.

The set is a number with a bit for each field, so it costs a record eight bytes and no strings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def presence(document: Column, fields: tuple[str, ...]) -> Column:
    """The bits of the fields that a JSON text has as keys; null if it is no object."""
    if len(fields) > 63:
        raise ValueError("a set of fields has 63 bits")
    keys = F.json_object_keys(document)
    bits = [F.when(F.array_contains(keys, f), 1 << k).otherwise(0) for k, f in enumerate(fields)]
    total = reduce(lambda a, b: a + b, [b.cast("bigint") for b in bits])
    return F.when(keys.isNotNull(), total)


def is_present(bits: Column, fields: tuple[str, ...], name: str) -> Column:
    """Whether a field is in the set."""
    return bits.bitwiseAND(F.lit(1 << fields.index(name))) != 0
