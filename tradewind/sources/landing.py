"""Typed scans of landing folders.

A landing is a folder of JSON-lines or parquet documents.  Schemas are always
given, never inferred, so a scan starts without a pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.presence import presence

ARRIVAL = "_arrival"
ARRIVAL_SCHEMA = "STRUCT<time: TIMESTAMP, file: STRING, offset: BIGINT, row: BIGINT>"
#: The text of a document that does not parse, or not with the types it should have.
CORRUPT = "_corrupt"
#: A file that lands with a time so far behind the newest one's would be ignored by a stream.
MAX_FILE_AGE = "36500d"
#: Which fields a document has.
PRESENT = "_present"


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows; the limit lets the optimizer drop joins with it before they run."""
    return spark.createDataFrame([], schema).limit(0)


def _fmt(fmt: str) -> str:
    if fmt not in ("json", "parquet"):
        raise ValueError(f"landing format must be json or parquet, not {fmt!r}")
    return fmt


def _typed(reader, schema: str, fmt: str):
    """A reader of documents that keeps the text of those it cannot read."""
    reader = reader.format(_fmt(fmt)).schema(f"{schema}, {CORRUPT} STRING")
    return reader.option("columnNameOfCorruptRecord", CORRUPT) if fmt == "json" else reader


def read_landing(
    spark: SparkSession, path: str, schema: str, fmt: str = "json", where: Column | None = None
) -> DataFrame:
    """Scan a landing folder; an absent key reads as null.

    ``_corrupt`` has the whole text of an unreadable document, whose fields are null.
    """
    df = _typed(spark.read, schema, fmt).load(path)
    return df if where is None else df.filter(where)


def read_records(
    spark: SparkSession, path: str, schema: str, fields: tuple[str, ...], into: str = PRESENT
) -> DataFrame:
    """Scan a landing of JSON lines with, in ``into``, which of some fields each document has.

    An absent key reads as null, like one that is null; only the set of fields tells them apart.
    A line that is no object is in ``_corrupt``, without fields.
    """
    lines = spark.read.text(path).select("value", "_metadata")
    given = F.from_json(
        "value", f"{schema}, {CORRUPT} STRING", {"columnNameOfCorruptRecord": CORRUPT}
    )
    return lines.select(
        given.alias("_given"), presence(F.col("value"), fields).alias(into), "_metadata"
    ).select("_given.*", into, "_metadata")


def stream_landing(
    spark: SparkSession, path: str, schema: str, fmt: str = "json", files_per_batch: int = 1000
) -> DataFrame:
    """The same scan as a stream of newly landed files, with their ``_metadata``."""
    return (
        _typed(spark.readStream, schema, fmt)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", MAX_FILE_AGE)
        .load(path)
        .select("*", "_metadata")
    )


def with_arrival(landed: DataFrame) -> DataFrame:
    """Add ``_arrival``, the order in which documents of a file landing came.

    Files are ordered by their time, then name; rows by their place in the file
    (the row number grows along a file split, and splits start at increasing
    offsets).  Needs a file scan, or a batch of a file stream, as it reads the
    ``_metadata`` column.  Filter before calling: the row number blocks pushdown.
    """
    meta = F.col("_metadata")
    arrival = F.struct(
        meta["file_modification_time"].alias("time"),
        meta["file_path"].alias("file"),
        meta["file_block_start"].alias("offset"),
        F.monotonically_increasing_id().alias("row"),
    )
    return landed.withColumn(ARRIVAL, arrival).drop("_metadata")


def point_lookup(df: DataFrame, key: str, value, columns: list[str] | None = None) -> DataFrame:
    """Rows with this key, optionally only some columns; empty for an empty key."""
    found = df.filter(F.col(key) == F.lit(value)) if value not in (None, "") else df.limit(0)
    return found.select(*columns) if columns else found
