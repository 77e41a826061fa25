"""A stored copy of the current listings that pages and searches read parts of.

The copy is sorted by id and cut into ranges, a folder each, so what follows a cursor is one range or a
few, however far on it is.  Beside it are the postings of the titles' trigrams, a folder for each hash
bucket of them: a search reads those of its rarest trigrams, and of the listings only the ranges in
which candidates are; these are then compared exactly.

Both are made from a landing at once and do not change; a new one is made in another folder.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewind.operators.current import current
from tradewind.sources.files import Folder

RANGE, PART = "_range", "_part"
LISTINGS, RANGES, POSTINGS, GRAMS = "listings", "ranges", "postings", "grams"
WHOLE = "schema.json"
SCHEMAS = {
    RANGES: f"{RANGE} INT, first STRING, last STRING, n BIGINT",
    POSTINGS: f"gram STRING, id STRING, {RANGE} INT, {PART} INT",
    GRAMS: f"gram STRING, n BIGINT, {PART} INT",
}
#: Letters of a gram, and how many of a query's grams are looked up, the rarest.
GRAM = 3
RAREST = 3
#: Folders of the postings.
PARTS = 64
#: Ranges that are looked at first for a page with conditions; then twice as many, and so on.
AHEAD = 4


def grams_of(title: Column) -> Column:
    """The distinct trigrams of a title in lower case; code points, in one pass."""
    # Not from the second half of a character that has two.
    pattern = rf"(?s)(?!\p{{Cs}})(?=(.{{{GRAM}}}))"
    found = F.regexp_extract_all(F.lower(title), F.lit(pattern), F.lit(1))
    return F.array_distinct(found)


def _part(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(PARTS)).cast("int")


def build(
    spark: SparkSession, folder: str, listings: DataFrame, ord: str, ranges: int | None = None
) -> ListingIndex:
    """Write the index of the current copies of all listings that have an id."""
    root = folder.rstrip("/")
    found = current(listings, "id", ord).filter(F.col("id").isNotNull()).drop(ord)
    dealt = found.repartitionByRange(*([ranges] if ranges else []), "id").sortWithinPartitions("id")
    numbered = dealt.withColumn(RANGE, F.spark_partition_id())
    numbered.write.partitionBy(RANGE).parquet(f"{root}/{LISTINGS}")
    stored = spark.read.schema(numbered.schema).parquet(f"{root}/{LISTINGS}")
    stored.groupBy(RANGE).agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n")
    ).select("_range", "first", "last", "n").write.parquet(f"{root}/{RANGES}")
    pairs = stored.select(F.explode(grams_of(F.col("title"))).alias("gram"), "id", RANGE)
    # A frequent gram has as many rows as listings: its bucket's rows are split into files.
    pairs.withColumn(PART, _part(F.col("gram"))).hint("rebalance", PART).sortWithinPartitions(
        PART, "gram", "id"
    ).write.partitionBy(PART).parquet(f"{root}/{POSTINGS}")
    written = spark.read.schema(SCHEMAS[POSTINGS]).parquet(f"{root}/{POSTINGS}")
    counts = written.groupBy("gram").agg(F.count("*").alias("n"))
    counts.withColumn(PART, _part(F.col("gram"))).repartition(PART).sortWithinPartitions(
        "gram"
    ).write.partitionBy(PART).parquet(f"{root}/{GRAMS}")
    # Written last: an index without it is not whole.
    Folder(spark, root).create(WHOLE, numbered.schema.json())
    return ListingIndex(spark, root)


class ListingIndex:
    """Reads parts of an index that ``build`` has written."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.root = spark, folder.rstrip("/")
        schema = StructType.fromJson(json.loads(Folder(spark, self.root).read(WHOLE)))
        self.listings = spark.read.schema(schema).parquet(f"{self.root}/{LISTINGS}")
        self.ranges = self._read(RANGES)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{name}")

    # --- pages -------------------------------------------------------------------

    def seek(self, after: str | None, limit: int, where: Column | None = None) -> DataFrame:
        """The first listings behind a cursor, the last id of the page before, that meet a condition.

        Without a condition the ranges to read follow from their sizes.  With one as many are read as
        it takes to fill the page.
        """
        if limit <= 0:
            return self.listings.drop(RANGE).limit(0)
        numbers = self._ranges_behind(after, limit if where is None else None)
        found = self._behind(numbers, after, where)
        while where is not None and found.limit(limit).count() < limit:
            more = self._ranges_behind(after, None, 2 * len(numbers))
            if len(more) == len(numbers):
                break
            numbers = more
            found = self._behind(numbers, after, where)
        return found.orderBy("id").limit(limit)

    def pages(self, limit: int, where: Column | None = None) -> Iterator[DataFrame]:
        """All listings that meet a condition, page by page."""
        after = None
        while True:
            page = self.seek(after, limit, where)
            # One row: the cursor of the next page.
            last, n = page.agg(F.max("id"), F.count("*")).first()
            if n:
                yield page
            if n < limit:
                return
            after = last

    def numbered_pages(self, limit: int, where: Column | None = None) -> DataFrame:
        """The listings of all pages that ``pages`` would give, with the number of the ``page``, from 0.

        In one pass over the ranges however many pages there are: what meets the condition is counted in each
        range, and of the ranges before only these counts are added up.
        """
        met = self.listings if where is None else self.listings.filter(where)
        # One row for each range.
        ahead = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        before = met.groupBy(RANGE).agg(F.count("*").alias("_n")).select(
            RANGE, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before")
        )
        place = F.row_number().over(Window.partitionBy(RANGE).orderBy("id")) - 1
        placed = met.withColumn("_place", place).join(before, RANGE)
        page = F.floor((F.col("_before") + F.col("_place")) / limit).cast("int")
        return placed.withColumn("page", page).drop(RANGE, "_place", "_before")

    def _ranges_behind(self, after: str | None, rows: int | None, least: int = AHEAD) -> list[int]:
        """Numbers of the ranges that hold so many rows behind the cursor, or of some at least."""
        behind = self.ranges if after is None else self.ranges.filter(F.col("last") > after)
        count = least
        while True:
            first = behind.orderBy(RANGE).limit(count).collect()
            # Of the first one the cursor may leave a single row.
            if rows is None or len(first) < count or sum(r.n for r in first[1:]) >= rows:
                break
            count *= 2
        if rows is None:
            return [r[RANGE] for r in first]
        numbers, held = [], 0
        for k, r in enumerate(first):
            numbers.append(r[RANGE])
            held += r.n if k or after is None else 1
            if held >= rows:
                break
        return numbers

    def _behind(self, numbers: list[int], after: str | None, where: Column | None) -> DataFrame:
        found = self.listings.filter(F.col(RANGE).isin(numbers)) if numbers else self.listings.limit(0)
        if after is not None:
            found = found.filter(F.col("id") > after)
        return (found if where is None else found.filter(where)).drop(RANGE)

    # --- searches ------------------------------------------------------------------

    def search(self, query: str) -> DataFrame:
        """Listings whose title contains the query, case ignored; no order.

        Queries shorter than a gram scan all titles.
        """
        text = query.lower()
        contains = F.contains(F.lower("title"), F.lit(text))
        if len(text) < GRAM:
            return self.listings.filter(contains).drop(RANGE)
        grams = sorted({text[k : k + GRAM] for k in range(len(text) - GRAM + 1)})
        counts = self._of_grams(GRAMS, grams).collect()
        if len(counts) < len(grams):
            return self.listings.drop(RANGE).limit(0)
        rarest = [r.gram for r in sorted(counts, key=lambda r: (r.n, r.gram))[:RAREST]]
        postings = self._of_grams(POSTINGS, rarest)
        candidates = postings.groupBy("id", RANGE).agg(F.count("*").alias("n"))
        candidates = candidates.filter(F.col("n") == len(rarest)).select("id", RANGE)
        # Where the candidates are few, Spark reads their ranges alone.
        return self.listings.join(candidates, ["id", RANGE], "left_semi").filter(contains).drop(RANGE)

    def _of_grams(self, name: str, grams: list[str]) -> DataFrame:
        """Rows of some grams, from their buckets; a query has few."""
        asked = self.spark.createDataFrame([(g,) for g in grams], "gram STRING")
        parts = [r[0] for r in asked.select(_part(F.col("gram"))).distinct().collect()]
        return self._read(name).filter(F.col(PART).isin(parts) & F.col("gram").isin(grams)).drop(PART)
