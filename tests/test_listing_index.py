"""Pages and searches from the stored index against plain scans."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tradewind.operators.items import search
from tradewind.plans import listing_index
from tradewind.sources.landing import empty

SCHEMA = "id STRING, title STRING, seller_id BIGINT, category_id STRING, ord BIGINT"


def listings(spark, n=300):
    rng = random.Random(2)
    words = ["Ring", "steel", "String", "Öl", "ring-ing", "aaaa", "x", "", "été 🙂🙂🙂", "RİNG"]
    data = [
        (f"i{rng.randrange(n):04}", " ".join(rng.choices(words, k=rng.randrange(4))) or None, k % 7, "c", k)
        for k in range(n)
    ]
    data += [(None, "ring", 1, "c", n), ("i0000", "a ring at last", 3, "d", n + 1), ("zz", "tail", 3, "d", n + 2)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("index") / "i"
    return listing_index.build(spark, str(folder), listings(spark), "ord", ranges=9)


@pytest.fixture(scope="module")
def scan(spark):
    return search(listings(spark), "ord").filter("id IS NOT NULL").drop("ord").cache()


@pytest.mark.parametrize("limit", [7, 50, 1000])
def test_pages_joined_are_the_scan(index, scan, limit):
    pages = [[r.id for r in page.collect()] for page in index.pages(limit)]
    assert [i for page in pages for i in page] == sorted(r.id for r in scan.collect())
    assert all(len(page) == limit for page in pages[:-1]) and 0 < len(pages[-1]) <= limit


def test_pages_with_a_condition(index, scan):
    where = F.col("seller_id") == 3
    pages = [[r.id for r in page.collect()] for page in index.pages(5, where)]
    assert [i for page in pages for i in page] == sorted(r.id for r in scan.filter(where).collect())
    assert list(index.pages(5, F.lit(False))) == []


def test_a_page_reads_its_ranges_only(index):
    assert index.ranges.count() == 9
    numbers = index._ranges_behind("i0250", 5)
    assert len(numbers) <= 2 and 0 not in numbers
    assert index._ranges_behind("zz", 5) == [] and index.seek("zz", 5).isEmpty()
    assert index.seek(None, 0).isEmpty()
    assert "_range#" in plan(index.seek("i0250", 5)).split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize(
    "query", ["ring", "RING", "tri", "steel String", "aaaa", "aaaaa", "öl r", "🙂🙂🙂", "🙂🙂", "i", "", "nothing", "g-i"]
)
def test_searches_equal_the_scan(spark, index, scan, query):
    expected = scan.filter(F.contains(F.lower("title"), F.lit(query.lower())))
    assert rows(index.search(query)) == rows(expected)


def test_a_search_reads_buckets_of_its_grams(index):
    assert any("_part#" in x.split("]")[0] for x in plan(index.search("steel")).split("PartitionFilters: [")[1:])


def test_an_index_of_nothing(spark, tmp_path):
    index = listing_index.build(spark, str(tmp_path / "i"), empty(spark, SCHEMA), "ord")
    assert index.search("ring").isEmpty() and index.search("r").isEmpty()
    assert list(index.pages(5)) == []


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_numbered_pages_are_the_pages(spark, index, limit):
    for where in (None, F.col("seller_id") == 3, F.lit(False)):
        numbered = index.numbered_pages(limit, where)
        expected = [(n, r.id) for n, page in enumerate(index.pages(limit, where)) for r in page.collect()] if limit > 1 else [
            (n, r.id) for n, r in enumerate((index.listings if where is None else index.listings.filter(where)).orderBy("id").collect())
        ]
        assert rows(numbered, "page", "id") == sorted(expected, key=repr)


def test_all_pages_of_a_query_are_one_plan(spark):
    """However many pages there are: the plan does not grow with them."""
    from tradewind import queries

    before, queries.PAGE = queries.PAGE, 3
    try:
        found = queries.item_pages(spark, "/root/testdata/sf0.001")
        assert plan(found).count("Union") == 0 and found.agg({"page": "max"}).first()[0] > 10
    finally:
        queries.PAGE = before
