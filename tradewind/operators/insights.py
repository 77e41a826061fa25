"""Market figures for the declared but never filled columns and reports.

The tables have columns such as ``price_position`` and ``growth_rate`` without any
stated formula; the definitions here are ours.  Ranks and medians are computed from
counts per distinct value, so no task ever holds all rows of a category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import py_round, safe_divide
from tradewind.operators.lookup import match_salted

# How far from the category median a price is out of the ordinary.
PREMIUM, DISCOUNT = 1.10, 0.90
BUCKETS_PER_DOUBLING = 64


def _bucket(value: Column) -> Column:
    """A coarse, monotone step of a number: steps of about one percent."""
    size = F.floor(F.log2(F.abs(value) + 1) * BUCKETS_PER_DOUBLING)
    return F.when(value < 0, -size).otherwise(size)


def value_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per key and distinct value: ``n`` rows, ``before`` lower ones, ``total`` of the key.

    Running sums in two steps, over the buckets of a key and within a bucket.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(key, value)
        .agg(F.count("*").alias("n"))
        .withColumn("_bucket", _bucket(F.col(value)))
    )
    over_buckets = Window.partitionBy(key).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    in_bucket = Window.partitionBy(key, "_bucket").orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1
    )
    buckets = (
        counts.groupBy(key, "_bucket")
        .agg(F.sum("n").alias("_total"))
        .withColumn("_below", F.coalesce(F.sum("_total").over(over_buckets), F.lit(0)))
        .withColumn("total", F.sum("_total").over(Window.partitionBy(key)))
    )
    return (
        counts.withColumn("_inside", F.coalesce(F.sum("n").over(in_bucket), F.lit(0)))
        .join(buckets.drop("_total"), [key, "_bucket"])
        .select(key, value, "n", (F.col("_below") + F.col("_inside")).alias("before"), "total")
    )


def medians(df: DataFrame, key: str, value: str) -> DataFrame:
    """Exact median per key, the mean of the two middle values of an even count."""
    until = F.col("before") + F.col("n")

    def holds(position: Column) -> Column:
        return (F.col("before") <= position) & (position < until)

    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    middle = value_counts(df, key, value).filter(holds(low) | holds(high))
    return middle.groupBy(key).agg(((F.min(value) + F.max(value)) / 2).alias("median"))


def price_positions(items: DataFrame) -> DataFrame:
    """Items as premium, competitive or discount against their category's median."""
    typical = medians(items, "category_id", "current_price")
    priced = match_salted(items, typical, ["category_id"], F.col("item_id"), "inner")
    price, median = F.col("current_price"), F.col("median")
    return priced.select(
        "item_id",
        "category_id",
        F.when(price > median * PREMIUM, "premium")
        .when(price < median * DISCOUNT, "discount")
        .otherwise("competitive")
        .alias("price_position"),
    )


def competitor_ranks(items: DataFrame) -> DataFrame:
    """Rank of each item's price in its category, 1 for the cheapest; ties share one."""
    ranks = value_counts(items, "category_id", "current_price").select(
        "category_id", "current_price", (F.col("before") + 1).alias("competitor_rank")
    )
    ranked = match_salted(
        items, ranks, ["category_id", "current_price"], F.col("item_id"), "inner"
    )
    return ranked.select("item_id", "category_id", "competitor_rank")


def market_shares(orders: DataFrame) -> DataFrame:
    """Each seller's share of all order amounts, in percent; 0 if all amounts are."""
    revenue = orders.groupBy("seller_id").agg(F.sum("total_amount").alias("revenue"))
    # One row per seller is summed up, not the orders again.
    total = revenue.agg(F.sum("revenue").cast("double")).scalar()
    share = py_round(F.col("revenue").cast("double") / F.nullif(total, F.lit(0.0)) * 100, 2)
    return revenue.select(
        "seller_id", "revenue", F.coalesce(share, F.lit(0.0)).alias("market_share_pct")
    )


def growth_rates(trends: DataFrame) -> DataFrame:
    """Change of search volume in percent against the keyword's previous date.

    Volumes are summed per date first, so a group has one row per date.
    """
    daily = trends.groupBy("keyword", "category_id", "trend_date").agg(
        F.sum("search_volume").alias("search_volume")
    )
    by_date = Window.partitionBy("keyword", "category_id").orderBy("trend_date")
    last = F.lag("search_volume").over(by_date)
    return daily.withColumn("_last", last).select(
        "keyword",
        "category_id",
        "trend_date",
        "search_volume",
        F.when(F.col("_last") != 0, py_round(
            (F.col("search_volume") - F.col("_last")) / F.col("_last") * 100, 2
        )).alias("growth_rate"),
    )


def price_changes(history: DataFrame) -> DataFrame:
    """Recorded prices that differ from the item's previous one.

    Several records of an item at one time count once, by the highest record id, so
    a group has one row per run.
    """
    narrow = history.select("item_id", "recorded_at", "id", "price")
    recorded = narrow.groupBy("item_id", "recorded_at").agg(F.max_by("price", "id").alias("price"))
    by_time = Window.partitionBy("item_id").orderBy("recorded_at")
    return (
        recorded.withColumn("previous_price", F.lag("price").over(by_time))
        .filter(F.col("price") != F.col("previous_price"))
        .select("item_id", "recorded_at", "previous_price", "price")
    )


def sales_velocity(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Units sold per item and day, over the days from its first to its last sale."""
    sold = lines.join(
        orders.select(F.col("id").alias("order_id"), F.to_date("date_created").alias("day")),
        "order_id",
    )
    per_item = sold.groupBy("item_id").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("units"),
        (F.datediff(F.max("day"), F.min("day")) + 1).alias("days"),
    )
    return per_item.withColumn("units_per_day", safe_divide(F.col("units"), F.col("days")))


def variant_performance(items: DataFrame) -> DataFrame:
    """Sales, views and conversion per brand, size and colour."""
    return _with_conversion(items.groupBy("brand", "size", "color").agg(*_sums()))


def category_segments(items: DataFrame) -> DataFrame:
    """Listings, average price, sales, views and conversion per category.

    Prices are summed exactly, to ten decimals.  Where a price is too large for that, as doubles.
    """
    price = F.col("current_price")
    exact = price.try_cast("decimal(28,10)")
    fits = F.count_if(price.isNotNull() & exact.isNull()) == 0
    total = F.when(fits, F.try_sum(exact).cast("double"))
    total = F.coalesce(total, F.sum(price))
    return _with_conversion(
        items.groupBy("category_id").agg(
            *_sums(), safe_divide(total, F.count("current_price"), 2).alias("avg_price")
        )
    )


def _sums() -> list[Column]:
    return [
        F.count("*").alias("n_items"),
        F.sum("sold_quantity").alias("sold_quantity"),
        F.sum("views").alias("views"),
    ]


def _with_conversion(totals: DataFrame) -> DataFrame:
    rate = safe_divide(F.col("sold_quantity"), F.col("views"))
    return totals.withColumn("conversion_rate", rate)
