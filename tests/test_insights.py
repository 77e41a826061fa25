import random
import statistics

import pytest

from tradewind.operators import insights

from conftest import rows


@pytest.fixture(scope="module")
def priced(spark):
    """A third of all items is in one category, and many of those share a price."""
    rng = random.Random(11)
    data = []
    for n in range(1500):
        category = "hot" if n % 3 == 0 else rng.choice("abcdef")
        price = 0.0 if n % 9 == 0 else round(rng.choice([1, 100, 1e6]) * rng.random() - 0.1, 2)
        data.append((f"i{n}", category, price))
    data += [("n1", "a", None), ("n2", "only", 5.0)]
    return spark.createDataFrame(data, "item_id STRING, category_id STRING, current_price DOUBLE")


def by_category(df):
    groups = {}
    for item, category, price in df.collect():
        if price is not None:
            groups.setdefault(category, []).append((item, price))
    return groups


def test_ranks_and_medians(priced):
    groups = by_category(priced)
    expected = sorted(
        (item, c, 1 + sum(p < price for _, p in g)) for c, g in groups.items() for item, price in g
    )
    assert rows(insights.competitor_ranks(priced)) == sorted(expected, key=repr)
    got = dict(insights.medians(priced, "category_id", "current_price").collect())
    assert got == pytest.approx({c: statistics.median(p for _, p in g) for c, g in groups.items()})


def test_positions(spark):
    df = spark.createDataFrame(
        [("a", "c", 100.0), ("b", "c", 110.5), ("d", "c", 89.0), ("e", "c", 105.0), ("f", "c", 95.0)],
        "item_id STRING, category_id STRING, current_price DOUBLE",
    )
    assert rows(insights.price_positions(df), "item_id", "price_position") == [
        ("a", "competitive"), ("b", "premium"), ("d", "discount"), ("e", "competitive"),
        ("f", "competitive"),
    ]


def test_growth(spark):
    df = spark.createDataFrame(
        [("k", "c", "2024-01-01", 4), ("k", "c", "2024-01-01", 4), ("k", "c", "2024-01-03", 6),
         ("k", "c", "2024-01-05", 0), ("k", "c", "2024-01-06", 3), ("l", "c", "2024-01-02", 3)],
        "keyword STRING, category_id STRING, d STRING, search_volume BIGINT",
    ).selectExpr("*", "CAST(d AS DATE) AS trend_date")
    got = insights.growth_rates(df).orderBy("keyword", "trend_date").collect()
    assert [r.growth_rate for r in got] == [None, -25.0, -100.0, None, None]


def test_price_changes(spark):
    df = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 6.0), ("a", 4, 5.0), ("b", 1, 1.0)],
        "item_id STRING, day INT, price DOUBLE",
    ).selectExpr("*", "CAST(day AS BIGINT) AS id", "CAST(date_add(DATE'2024-01-01', day) AS TIMESTAMP_NTZ) AS recorded_at")
    assert rows(insights.price_changes(df), "item_id", "previous_price", "price") == [
        ("a", 5.0, 6.0), ("a", 6.0, 5.0)
    ]


def test_average_price_is_rounded_once(spark):
    df = spark.createDataFrame(
        [("c", p, 1, 2) for p in (1.004, 1.004, 1.008)],
        "category_id STRING, current_price DOUBLE, sold_quantity BIGINT, views BIGINT",
    )
    assert insights.category_segments(df).first().avg_price == 1.01


def test_average_of_very_large_prices(spark):
    df = spark.createDataFrame(
        [("a", 1e19), ("a", 3e19), ("a", None), ("b", 1e18), ("b", 1.0)], "category_id STRING, current_price DOUBLE"
    ).selectExpr("*", "1L AS sold_quantity", "2L AS views")
    got = insights.category_segments(df)
    assert rows(got, "category_id", "avg_price") == [("a", 2e19), ("b", 5e17)]


def test_shares_of_nothing(spark):
    df = spark.createDataFrame([(1, "0.00"), (2, "0.00")], "seller_id BIGINT, t STRING")
    df = df.selectExpr("seller_id", "CAST(t AS DECIMAL(10,2)) AS total_amount")
    assert rows(insights.market_shares(df), "seller_id", "market_share_pct") == [(1, 0.0), (2, 0.0)]
