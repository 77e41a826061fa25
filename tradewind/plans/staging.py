"""Intermediate tables that a run reads several times.

They are written to the folder the cluster names in ``spark.checkpoint.dir``, so they
survive the loss of an executor, cut the lineage and stay columnar: each reader
scans only its columns.

The planner takes the size of a file for that of its rows, but a folder of JSON texts or of row numbers that
fills a few MB can be hundreds in memory, more than the driver has for a broadcast.  While a run is on, sizes of
files are therefore taken times ``UNPACKED``: what is broadcast then really is small, everything else is shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tradewind.session import shared_folder
from tradewind.sources.files import Folder

FACTOR = "spark.sql.sources.fileCompressionFactor"
#: How often rows in a hash table are larger than in their file; texts of documents were found to be 30 to 40 times.
UNPACKED = 40.0


class Stage:
    """A folder of staged tables."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` once and return a scan of what was written."""
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        Folder(self.spark, self.root).delete()


@contextmanager
def staging(spark: SparkSession) -> Iterator[Stage]:
    """Staged tables that are removed when the run is over."""
    stage = Stage(spark)
    before = spark.conf.get(FACTOR)
    spark.conf.set(FACTOR, str(max(UNPACKED, float(before))))
    try:
        yield stage
    finally:
        spark.conf.set(FACTOR, before)
        stage.drop()
