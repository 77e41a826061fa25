"""The listing run: select, enrich, and load items, sellers and price history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.items import (
    copies_of_sellers,
    drop_empty,
    enrich,
    listings_of,
    of_sellers,
    split_by_price,
    with_seller,
)
from tradewind.operators.reports import seller_outcomes
from tradewind.operators.rollup import roll_listings
from tradewind.operators.topk import cutoffs, up_to_cutoff
from tradewind.operators.upsert import (
    price_records,
    upsert_items,
    upsert_sellers,
    with_item_id,
)
from tradewind.plans.staging import Stage, staging
from tradewind.plans.tables import TableStore, Touched
from tradewind.sources.landing import ARRIVAL, CORRUPT


def run_items(
    store: TableStore,
    listings: DataFrame,
    run_id: str,
    as_of: str | dt.datetime,
    ord: str,
    limit: int | None = None,
    status: str = "active",
    sellers: list[int] | None = None,
) -> DataFrame:
    """Load the current listings with a status; returns the outcome per seller.

    ``ord`` is the column of arrival order.  All sellers run as one job; with ``limit``
    each has only its first listings loaded.  With ``sellers`` those that are theirs now.  A run id that was loaded before changes
    nothing.
    """
    spark = store.spark
    store.refresh()
    if not store.has_run(run_id):
        with staging(spark) as stage:
            listings = drop_empty(with_seller(listings))
            if sellers is not None:
                listings = copies_of_sellers(listings, sellers)
            if ord == ARRIVAL:
                # Parsed once, and row numbers must not change between two reads.
                listings = stage.put("landed", listings)
            readable, unreadable = split_by_price(listings)
            if sellers is not None:
                corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in listings.columns else F.lit(False)
                unreadable = unreadable.filter(of_sellers(sellers) | corrupt)
            found = listings_of(readable, ord, status, sellers)
            chosen = stage.put("listings", _chosen(stage, found, ord, limit))
            records = stage.put("records", enrich(chosen, as_of, keep=(ord,)))
            if sellers is None:
                requested = listings.select("seller_id").filter("seller_id IS NOT NULL")
            else:
                requested = spark.createDataFrame([(s,) for s in sellers], "seller_id BIGINT")
            changes = load_records(store, records, run_id, as_of, ord)
            changes["quarantine"] = _quarantined(unreadable)
            changes["run_outcomes"] = seller_outcomes(
                requested, with_item_id(records)
            ).withColumn("run_id", F.lit(run_id))
            store.commit(run_id, changes)
    return store.read("run_outcomes", run_id).drop("run_id")


def _chosen(stage: Stage, listings: DataFrame, ord: str, limit: int | None) -> DataFrame:
    """Each seller's first listings; the few cutoffs are staged: known small, they are broadcast."""
    if limit is None:
        return listings
    if limit <= 0:
        return listings.limit(0)
    known = listings.filter(F.col("seller_id").isNotNull())
    cuts = stage.put("cutoffs", cutoffs(known, "seller_id", [ord], limit))
    return up_to_cutoff(listings, cuts, "seller_id", [ord])


def run_records(
    store: TableStore, records: DataFrame, run_id: str, as_of: str | dt.datetime, ord: str,
    present: str | None = None,
) -> bool:
    """Load records that are enriched already; False if this run was loaded before.

    ``present`` names the column that says which fields each record has, as ``read_records`` adds it.
    Lines that are no record are quarantined.
    """
    store.refresh()
    if store.has_run(run_id):
        return False
    with staging(store.spark) as stage:
        # Parsed once, and row numbers must not change between two reads.
        landed = stage.put("records", records)
        changes = {}
        if CORRUPT in landed.columns:
            broken = landed.filter(F.col(CORRUPT).isNotNull())
            landed = landed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
            changes["quarantine"] = broken.select(
                F.lit("records").alias("source"),
                F.lit(None).cast("string").alias("record_id"),
                F.lit("unreadable document").alias("reason"),
                F.col(CORRUPT).alias("raw_json"),
            )
        changes |= load_records(store, landed, run_id, as_of, ord, present)
        return store.commit(run_id, changes)


def load_records(
    store: TableStore, records: DataFrame, run_id: str, as_of: str | dt.datetime, ord: str,
    present: str | None = None,
) -> dict[str, DataFrame | Touched]:
    """New items and sellers tables and added price records for enriched records."""
    parts = store.parts_of("items", with_item_id(records).select("item_id"))
    stored = store.read("items", parts=parts)
    after = upsert_items(stored, records, ord, as_of, present)
    return {
        "items": Touched(after, parts),
        "category_sellers": roll_listings(store.read("category_sellers"), stored, after),
        "sellers": upsert_sellers(store.read("sellers"), records, ord),
        "price_history": price_records(records, ord, as_of, run_id),
    }


def _quarantined(listings: DataFrame) -> DataFrame:
    """The listings that cannot be read, as they came."""
    document = F.to_json(F.struct(*[c for c in listings.columns if not c.startswith("_")]))
    corrupt = F.col(CORRUPT) if CORRUPT in listings.columns else F.lit(None).cast("string")
    return listings.select(
        F.lit("items").alias("source"),
        F.col("id").alias("record_id"),
        F.when(corrupt.isNotNull(), "unreadable document")
        .otherwise("price is not a number")
        .alias("reason"),
        F.coalesce(corrupt, document).alias("raw_json"),
    )
