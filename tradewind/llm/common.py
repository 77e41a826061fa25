"""Helpers that the operators of this folder share."""

from __future__ import annotations

import ctypes
import functools
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.session import shared_folder
from tradewind.sources.files import Folder

#: A word is a run of anything but these six white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.coalesce(
        F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)), F.array().cast("array<string>")
    )


def quoted(name: str) -> Column:
    """A column by its plain name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row, also where lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(name: str) -> str:
    """A column name that no input has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def give_back() -> None:
    """Hand the memory that this Python worker has freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def giving_back(run):
    """``run`` of mapInArrow; what a task has freed is given back at its end.

    Spark keeps Python workers after a task, and Arrow and the C library keep what was freed in them: several
    times what the worker itself needs, beside whatever the next step takes in the JVM of the executor.
    """

    @functools.wraps(run)
    def lean(batches):
        yield from run(batches)
        give_back()

    return lean


class Scratch:
    """Intermediate Parquet tables in the shared folder.

    Written tables cut the lineage and survive lost executors. ``drop`` frees one that no
    later step reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
        self.folder = Folder(spark, self.root)
        # Results are read lazily, so the tables stay as long as the session.
        self.folder.delete_at_exit()

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table and return a scan of it; the shuffle files of the step go at once."""
        conf, key = self.spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = conf.get(key, "false")
        conf.set(key, "true")
        try:
            df.write.option("compression", "zstd").parquet(f"{self.root}/{name}")
        finally:
            conf.set(key, before)
        return self.get(name, df)

    def get(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        self.folder.delete(name)
