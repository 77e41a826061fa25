"""Listings: selection, descriptions and reviews, enrichment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import (
    as_of_literal,
    discount_pct,
    get_attr,
    not_a_number,
    or_zero,
    safe_divide,
    to_double,
)
from tradewind.operators.current import current, one_per_key
from tradewind.operators.lookup import lookup, match_salted
from tradewind.operators.topk import first_per_key, page
from tradewind.sources.landing import CORRUPT

NOT_AVAILABLE = "N/A"


def with_seller(listings: DataFrame) -> DataFrame:
    """Listings whose seller may stand in a nested object, as in search results."""
    if "seller" not in listings.columns:
        return listings
    seller = F.coalesce("seller_id", "seller.id")
    return listings.withColumn("seller_id", seller).drop("seller")


def of_sellers(sellers: list[int]) -> Column:
    """Whether a listing is one of some sellers'; never null."""
    return F.coalesce(F.col("seller_id").isin(sellers), F.lit(False)) if sellers else F.lit(False)


def copies_of_sellers(listings: DataFrame, sellers: list[int]) -> DataFrame:
    """All copies of the listings that were some sellers' at any time.

    They are what is needed to tell whose a listing is now.  Documents that cannot be read stay too.
    """
    own = of_sellers(sellers)
    ids = listings.filter(own & F.col("id").isNotNull()).select(F.col("id").alias("_id")).distinct()
    found = match_salted(
        listings.withColumn("_id", F.col("id")), ids.withColumn("_own", F.lit(True)), ["_id"],
        F.struct("seller_id", "status", "price"), "left",
    )
    wanted = F.col("_own").isNotNull() | own
    if CORRUPT in listings.columns:
        wanted = wanted | F.col(CORRUPT).isNotNull()
    return found.filter(wanted).select(*listings.columns)


def listings_of(
    listings: DataFrame, ord: str, status: str = "active", sellers: list[int] | None = None
) -> DataFrame:
    """Current copies of the listings with a status, of some sellers or of all (``None``).

    The last copy decides: an older one may have another status, or another seller.
    """
    found = current(listings, "id", ord).filter(F.col("status") == status)
    return found if sellers is None else found.filter(of_sellers(sellers))


def seller_listings(
    listings: DataFrame,
    ord: str,
    limit: int | None = None,
    status: str = "active",
    sellers: list[int] | None = None,
) -> DataFrame:
    """Listings with a status, all or each seller's first ``limit`` in the order of ``ord``."""
    found = listings_of(listings, ord, status, sellers)
    return first_per_key(found, "seller_id", [ord], limit, keep_unkeyed=True)


def with_details(found: DataFrame, listings: DataFrame, ord: str) -> DataFrame:
    """Full current documents of the listing ids found by a search."""
    return found.select("id").join(current(listings, "id", ord), "id")


def search(
    listings: DataFrame,
    ord: str,
    query: str | None = None,
    seller_id: int | None = None,
    category: str | None = None,
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """Current listings that meet all given conditions; with ``limit`` one page of them, by id.

    The text condition is ours: the title contains the query, case ignored.
    """
    found = current(listings, "id", ord)
    if query:
        found = found.filter(F.contains(F.lower("title"), F.lit(query.lower())))
    if seller_id:
        found = found.filter(F.col("seller_id") == seller_id)
    if category:
        found = found.filter(F.col("category_id") == category)
    return found if limit is None else page(found, [F.col("id")], limit, offset)


def attach_descriptions(listings: DataFrame, descriptions: DataFrame, ord: str) -> DataFrame:
    """Add ``description``: 'N/A' if there is none, null for a listing without id.

    Of several descriptions of an item the last one in the order of their ``ord`` counts.
    """
    text = descriptions.select("item_id", F.col("plain_text").alias("description"), ord)
    joined = lookup(listings, one_per_key(text, "item_id", ord), "id", "item_id")
    return joined.withColumn(
        "description",
        F.when(_has_id(), F.coalesce("description", F.lit(NOT_AVAILABLE))),
    )


def attach_reviews(listings: DataFrame, reviews: DataFrame, ord: str) -> DataFrame:
    """Add ``rating_average`` and ``total_reviews``, 0 without reviews; the last copy by ``ord`` counts."""
    rated = reviews.select("item_id", "rating_average", "total_reviews", ord)
    joined = lookup(listings, one_per_key(rated, "item_id", ord), "id", "item_id")
    return joined.withColumns(
        {
            "rating_average": F.when(_has_id(), F.coalesce("rating_average", F.lit(0.0))),
            "total_reviews": F.when(_has_id(), F.coalesce("total_reviews", F.lit(0))),
        }
    )


def extract(
    listings: DataFrame,
    ord: str,
    limit: int | None = None,
    descriptions: DataFrame | None = None,
    reviews: DataFrame | None = None,
    status: str = "active",
    sellers: list[int] | None = None,
) -> DataFrame:
    """Listings, all or each seller's first, with descriptions and reviews where given.

    All three have their order of arrival in a column ``ord``.
    """
    found = seller_listings(listings, ord, limit, status, sellers)
    if descriptions is not None:
        found = attach_descriptions(found, descriptions, ord)
    return found if reviews is None else attach_reviews(found, reviews, ord)


def _has_id() -> Column:
    return F.col("id").isNotNull() & (F.col("id") != "")


def item_questions(
    questions: DataFrame, ord: str = "question_id", limit: int | None = None
) -> DataFrame:
    """The questions of each item, all or the first, with the item's ``total`` of them."""
    totals = questions.groupBy("item_id").agg(F.count("*").alias("total"))
    return first_per_key(questions, "item_id", [ord], limit).join(totals, "item_id")


def trends(landed: DataFrame, site: str, category: str | None = None) -> DataFrame:
    """Trending keywords of a site, optionally of one category."""
    found = landed.filter(F.col("site_id") == site)
    return found.filter(F.col("category_id") == category) if category else found


def drop_empty(listings: DataFrame) -> DataFrame:
    """Drop documents without any value (null or ``{}`` elements of a list).

    Done once where documents are loaded; what works on loaded ones reads fewer columns.
    """
    fields = [c for c in listings.columns if not c.startswith("_") or c == CORRUPT]
    return listings.filter(F.greatest(*[F.col(c).isNotNull() for c in fields]))


def unreadable_price(column: str) -> Column:
    """True for a price that is a text but no finite number."""
    value = to_double(F.col(column))
    infinite = value.isNotNull() & (F.isnan(value) | (F.abs(value) == float("inf")))
    return not_a_number(F.col(column)) | infinite


def split_by_price(listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Listings that can be read, and the ones to quarantine."""
    bad = unreadable_price("price") | unreadable_price("original_price")
    if CORRUPT in listings.columns:
        bad = bad | F.col(CORRUPT).isNotNull()
    return listings.filter(~bad), listings.filter(bad)


def enrich(
    listings: DataFrame, as_of: str | dt.datetime, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Flat listing records with attributes, prices, conversion and discount.

    ``keep`` names further input columns to carry along, such as the order of
    arrival.  One projection; an unreadable price gives null, so split first.
    """
    now = as_of_literal(as_of)
    attributes = F.col("attributes")
    priced = listings.withColumns(
        {
            "current_price": _price(F.col("price")),
            "sold_quantity": or_zero(F.col("sold_quantity")),
            "views": or_zero(F.col("views")),
        }
    )
    priced = priced.withColumn(
        "original_price",
        F.coalesce(F.nullif(_price(F.col("original_price")), F.lit(0.0)), "current_price"),
    )
    return priced.select(
        F.col("id").alias("item_id"),
        "title",
        "category_id",
        "current_price",
        "original_price",
        "available_quantity",
        "sold_quantity",
        "condition",
        get_attr(attributes, "BRAND").alias("brand"),
        get_attr(attributes, "SIZE").alias("size"),
        get_attr(attributes, "MAIN_COLOR").alias("color"),
        get_attr(attributes, "GENDER").alias("gender"),
        "views",
        safe_divide(F.col("sold_quantity"), F.col("views")).alias("conversion_rate"),
        "seller_id",
        now.alias("created_at"),
        now.alias("updated_at"),
        discount_pct(F.col("original_price"), F.col("current_price")).alias(
            "discount_percentage"
        ),
        *keep,
    )


def _price(text: Column) -> Column:
    return F.when(text.isNull() | (text == ""), F.lit(0.0)).otherwise(to_double(text))
