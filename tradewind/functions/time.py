"""Wall-clock times: everything is TIMESTAMP_NTZ, so no session zone matters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the extended ISO forms that are read as a time.
ISO_DATE_TIME = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)
# Fixed value: the zone part at the end of such a text.
ISO_ZONE = r"(Z|[+-]\d{2}:?\d{2})$"


def wall_clock(text: Column) -> Column:
    """Time in an ISO text, zone suffix dropped, clock reading kept; else null.

    The pattern is needed because the cast alone also accepts ``'2024'``.
    """
    local = F.regexp_replace(F.replace(text, F.lit(","), F.lit(".")), ISO_ZONE, "")
    return F.when(text.rlike(ISO_DATE_TIME), local.try_cast("timestamp_ntz"))


def hours_between(start: Column, end: Column) -> Column:
    """Hours from ``start`` to ``end``, negative if they are reversed."""
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return (seconds / 3600).try_cast("decimal(10,2)")


def iso_text(ts: Column) -> Column:
    """ISO text; six fraction digits appear only if the fraction is not zero."""
    text = F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))
    return F.when(F.contains(text, F.lit(".")), F.rpad(text, 26, "0")).otherwise(text)


def as_of_literal(as_of: str | dt.datetime) -> Column:
    """Literal of one run's load time (UTC); zone-aware values are converted."""
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_now() -> dt.datetime:
    """The clock, read only where a run starts."""
    return dt.datetime.now(dt.timezone.utc)
