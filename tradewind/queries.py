"""The registered queries: every operator over the given tables.

Each takes (spark, sf_dir).  Fixed run times and parameters are shared with the
equivalent SQL in ``oracles``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.functions import get_attr
from tradewind.operators import insights, items, order_json, orders, reports, rollup, upsert
from tradewind.operators.current import one_per_key
from tradewind.plans import listing_index
from tradewind.plans.items_run import run_items
from tradewind.plans.orders_run import run_orders
from tradewind.plans.replay import replay_orders
from tradewind.plans.staging import staging
from tradewind.plans.tables import TableStore
from tradewind.session import shared_folder
from tradewind.sources import testdata as td
from tradewind.sources.files import Folder
from tradewind.sources.landing import (
    PRESENT,
    empty,
    point_lookup,
    read_landing,
    read_records,
)
from tradewind.streaming.orders_stream import run_orders_stream

ORD = "ingest_ordinal"
RUN_1, RUN_2 = "2024-06-01 12:00:00", "2024-06-02 12:00:00"
# The limit of the one query that has a limit per seller.
LIMIT = 5
ITEM_ID = "MLB000000000042"
USER_ID = 7
SEARCH = {"query": "RING", "limit": 20, "offset": 20}
SEARCHES = ("ring", "Blue", "old p", "zzz", "re")
PAGE = 1000
CATEGORY = "PROMO"
START, END = "1996-01-01", "1997-06-30"


# --- listings --------------------------------------------------------------


def attr_extract(spark, sf):
    attributes = F.col("attributes")
    return td.raw_items(spark, sf).select(
        "id",
        *[
            get_attr(attributes, key).alias(name)
            for key, name in (
                ("BRAND", "brand"), ("SIZE", "size"), ("MAIN_COLOR", "color"),
                ("GENDER", "gender"),
            )
        ],
    )


def enrich_items(spark, sf):
    return items.enrich(items.drop_empty(td.raw_items(spark, sf)), RUN_1)


def items_active_limit(spark, sf):
    found = items.seller_listings(td.delivered_items(spark, sf), ORD, LIMIT)
    return found.select("id", "seller_id", "title", "status", "price")


def items_of_sellers(spark, sf):
    """Listings of some sellers as they are now, after some have changed hands."""
    found = items.seller_listings(td.moved_items(spark, sf), ORD, sellers=[td.BIG_SELLER, 2, 3])
    return found.select("id", "seller_id", "title", "price")


def items_active(spark, sf):
    found = items.seller_listings(td.delivered_items(spark, sf), ORD)
    return found.select("id", "seller_id", "title", "status", "price")


def item_details(spark, sf):
    listings = td.delivered_items(spark, sf)
    found = items.seller_listings(listings.select("id", "seller_id", "status", ORD), ORD)
    details = items.with_details(found, listings, ORD)
    return details.select(
        "id", "seller_id", "title", "category_id", "available_quantity", "condition",
        F.array_size("attributes").alias("n_attributes"),
    )


def item_lookup(spark, sf):
    return point_lookup(
        td.raw_items(spark, sf), "id", ITEM_ID, ["id", "title", "category_id", "seller_id"]
    )


def item_search_page(spark, sf):
    found = items.search(td.delivered_items(spark, sf), ORD, **SEARCH)
    return found.select("id", "title", "category_id", "seller_id")


def item_search_indexed(spark, sf):
    """Searches through the trigrams of titles; the last one is too short for them and scans."""
    index = listing_index.build(spark, _new_folder(spark), td.delivered_items(spark, sf), ORD)
    found = [
        index.search(query).select(F.lit(query).alias("query"), "id", "title")
        for query in SEARCHES
    ]
    return reduce(DataFrame.unionByName, found)


def item_pages(spark, sf):
    """All pages of the listings of one seller, each behind the last id of the one before."""
    index = listing_index.build(spark, _new_folder(spark), td.delivered_items(spark, sf), ORD)
    own = F.col("seller_id") == td.BIG_SELLER
    return index.numbered_pages(PAGE, own).select("page", "id", "title", "seller_id")


def items_with_descriptions(spark, sf):
    listings = td.raw_items(spark, sf).select("id", "title")
    return items.attach_descriptions(listings, td.raw_descriptions(spark, sf), ORD)


def items_with_reviews(spark, sf):
    listings = td.raw_items(spark, sf).select("id", "title")
    return items.attach_reviews(listings, td.raw_reviews(spark, sf), ORD)


def items_extract(spark, sf):
    listings = items.seller_listings(td.delivered_items(spark, sf), ORD)
    found = items.attach_descriptions(listings, td.raw_descriptions(spark, sf), ORD)
    found = items.attach_reviews(found, td.raw_reviews(spark, sf), ORD)
    return found.select(
        "id", "seller_id", "title", "description", "rating_average", "total_reviews"
    )


def item_questions(spark, sf):
    return items.item_questions(td.raw_questions(spark, sf), limit=3)


def user_lookup(spark, sf):
    users = one_per_key(td.raw_users(spark, sf), "id", ORD)
    return point_lookup(users, "id", USER_ID, ["id", "nickname"])


def category_trends(spark, sf):
    return items.trends(td.raw_trends(spark, sf), td.SITE, CATEGORY)


def price_quarantine(spark, sf):
    listings = td.raw_items(spark, sf).withColumn(
        "price", F.when(F.col("available_quantity") == 50, "on request").otherwise(F.col("price"))
    )
    readable, unreadable = items.split_by_price(listings)
    good = items.enrich(readable, RUN_1).select(
        "item_id", "current_price", F.lit("loaded").alias("outcome")
    )
    return good.unionByName(
        unreadable.select(
            F.col("id").alias("item_id"),
            F.lit(None).cast("double").alias("current_price"),
            F.lit("quarantined").alias("outcome"),
        )
    )


# --- sellers ---------------------------------------------------------------


def sellers_of_category(spark, sf):
    found = reports.category_sellers(td.delivered_items(spark, sf), ORD, CATEGORY)
    return reports.with_nicknames(found, td.raw_users(spark, sf), ORD)


def sellers_quick10(spark, sf):
    found = reports.quick_sellers(td.delivered_items(spark, sf), ORD, CATEGORY)
    return reports.with_nicknames(found, td.raw_users(spark, sf), ORD)


def category_seller_counts(spark, sf):
    return reports.count_sellers(td.delivered_items(spark, sf), ORD)


def _loaded_items(spark, sf):
    chosen = items.seller_listings(td.delivered_items(spark, sf), ORD)
    return upsert.with_item_id(items.enrich(chosen, RUN_1))


def seller_outcomes(spark, sf):
    users = td.raw_users(spark, sf).select(F.col("id").alias("seller_id")).distinct()
    return reports.seller_outcomes(users, _loaded_items(spark, sf))


def seller_run_summary(spark, sf):
    return reports.run_summary(seller_outcomes(spark, sf))


# --- orders ----------------------------------------------------------------


def orders_flat(spark, sf):
    return orders.flatten_orders(td.raw_orders(spark, sf))


def orders_json(spark, sf):
    """Fields of the free JSON of orders, from VARIANT columns that were stored, and its text again."""
    stored = f"{_new_folder(spark)}/order_json"
    order_json.order_json(orders_flat(spark, sf)).write.parquet(stored)
    parsed = spark.read.parquet(stored)
    parsed = order_json.with_fields(parsed, "context", {"segment": ("$.segment", "string")})
    parsed = order_json.with_fields(parsed, "tags", {"first_tag": ("$[0]", "string")})
    return parsed.select(
        "order_id", "segment", "first_tag", F.size("unparsed").alias("n_unparsed"),
        *[F.to_json(c).alias(f"{c}_text") for c in order_json.FIELDS],
    )


def order_tag_counts(spark, sf):
    return order_json.tag_counts(order_json.order_json(orders_flat(spark, sf)))


def order_items_flat(spark, sf):
    return orders.flatten_order_items(td.raw_orders(spark, sf)).drop("id")


def payments_flat(spark, sf):
    return orders.flatten_payments(td.raw_orders(spark, sf))


def orders_date_range(spark, sf):
    raw = orders.orders_in_range(td.raw_orders(spark, sf), START, END)
    return orders.flatten_orders(raw).select("id", "seller_id", "date_created")


def orders_of_seller(spark, sf):
    raw = orders.for_sellers(td.raw_orders(spark, sf), [td.BIG_SELLER])
    return orders.flatten_orders(raw).select("id", "seller_id", "buyer_id", "date_created")


def orders_new_only(spark, sf):
    seen = td.raw_orders(spark, sf, run=1).select("id")
    fresh = orders.unseen(td.raw_orders(spark, sf, run=2), seen)
    return orders.flatten_orders(fresh).select("id", "seller_id", "status", "total_amount")


def orders_quarantine(spark, sf):
    checked = orders.with_reject_reason(td.raw_orders(spark, sf, defects=True))
    return orders.rejected(checked).select("source", "record_id", "reason")


def orders_unreadable(spark, sf):
    """The quarantine of a landing with broken lines, with their original text."""
    folder = _new_folder(spark)
    td.land(td.order_texts(spark, sf), folder, "text")
    checked = orders.with_reject_reason(read_landing(spark, folder, schemas.RAW_ORDER))
    return orders.rejected(checked).select("source", "reason", "raw_json")


def orders_accepted(spark, sf):
    checked = orders.with_reject_reason(td.raw_orders(spark, sf, defects=True))
    return orders.flatten_orders(orders.accepted(checked)).select("id", "paid_amount", "currency_id")


def payment_conflicts(spark, sf):
    raw = td.raw_orders(spark, sf, defects=True)
    uses = raw.select(
        F.col("id").alias("order_id"), F.explode("payments.id").alias("payment_id")
    )
    return orders.shared_payments(uses)


def last_two_orders(spark, sf):
    found = reports.last_orders(orders_flat(spark, sf))
    return found.select("seller_id", "id", "date_created", "total_amount")


def last_order_documents(spark, sf):
    found = reports.last_order_documents(td.delivered_orders(spark, sf), ORD)
    return found.select(
        "seller_id", "id", "date_created",
        F.get_json_object("document", "$.status").alias("status"),
    )


def orders_by_status(spark, sf):
    return reports.orders_by_status(orders_flat(spark, sf))


def orders_date_span(spark, sf):
    return reports.order_date_span(orders_flat(spark, sf))


def _state_after(spark, sf, run, as_of, state=None):
    progress = upsert.seller_progress(
        orders.flatten_orders(td.raw_orders(spark, sf, run=run), keep=(ORD,)), ORD
    )
    state = empty(spark, schemas.ETL_STATE) if state is None else state
    return upsert.upsert_state(state, progress, "completed", as_of)


def seller_stats(spark, sf):
    """The stats documents, opened up into one row per seller and status."""
    stats = reports.seller_stats(orders_flat(spark, sf), _state_after(spark, sf, None, RUN_1))
    return stats.select(
        "seller_id",
        F.col("etl_state.status").alias("run_status"),
        F.col("etl_state.total_processed").alias("total_processed"),
        F.col("etl_state.last_run").alias("last_run"),
        F.col("etl_state.last_order_id").alias("last_order_id"),
        F.col("date_range.earliest").alias("earliest"),
        F.col("date_range.latest").alias("latest"),
        F.explode("order_counts").alias("status", "n_orders"),
    )


def seller_stats_json(spark, sf):
    stats = reports.seller_stats(orders_flat(spark, sf), _state_after(spark, sf, None, RUN_1))
    return reports.stats_json(stats)


def order_details(spark, sf):
    raw = td.raw_orders(spark, sf)
    details = orders.order_details(
        orders.flatten_orders(raw), orders.flatten_order_items(raw), orders.flatten_payments(raw)
    )
    return details.select(
        "order_id", "seller_id", "n_lines", "units", "lines_amount", "n_payments",
        "payments_amount",
    )


def order_lines(spark, sf):
    raw = td.raw_orders(spark, sf)
    joined = orders.order_lines(orders.flatten_orders(raw), orders.flatten_order_items(raw))
    return joined.select(
        "order_id", "seller_id", "status", "date_created", "item_id", "quantity", "unit_price"
    )


# --- upserts: run 1 into empty tables, then run 2 --------------------------


def _item_run(spark, sf, run, as_of):
    raw = td.raw_items(spark, sf, run=run)
    return td.seller_extras(items.enrich(raw, as_of, keep=(ORD,)))


def items_upsert(spark, sf):
    first = upsert.upsert_items(
        empty(spark, schemas.ITEMS), _item_run(spark, sf, 1, RUN_1), ORD, RUN_1
    )
    return upsert.upsert_items(first, _item_run(spark, sf, 2, RUN_2), ORD, RUN_2)


def items_partial_upsert(spark, sf):
    """Records from lines of JSON that lack different fields; others have them as null."""
    number, table = F.col(ORD), empty(spark, schemas.ITEMS)
    for run, as_of in ((1, RUN_1), (2, RUN_2)):
        records = items.enrich(td.raw_items(spark, sf, run=run), as_of, keep=(ORD,))
        without = {
            "title": (number + run) % 3 == 0,
            "current_price": number % 4 == run,
            "views": number % 5 < run,
            "brand": (number % 2 == 0) & (run == 2),
            "created_at": F.lit(True),
            "updated_at": number % 7 == run,
        }
        folder = _new_folder(spark)
        td.record_texts(records, without).write.text(folder)
        schema = f"{ORD} BIGINT, {schemas.RECORD}"
        landed = read_records(spark, folder, schema, upsert.ITEM_FIELDS)
        table = upsert.upsert_items(table, landed, ORD, as_of, PRESENT)
    return table.drop("updated_at")


def sellers_upsert(spark, sf):
    first = upsert.upsert_sellers(
        empty(spark, schemas.SELLERS), _item_run(spark, sf, 1, RUN_1), ORD
    )
    return upsert.upsert_sellers(first, _item_run(spark, sf, 2, RUN_2), ORD)


def price_history_append(spark, sf):
    runs = [
        upsert.price_records(_item_run(spark, sf, run, as_of), ORD, as_of, f"run-{run}")
        for run, as_of in ((1, RUN_1), (2, RUN_2))
    ]
    return runs[0].unionByName(runs[1]).drop("id")


def _children(spark, sf, run, field):
    """Last copy of each order document of a run, with one of its arrays."""
    raw = td.raw_orders(spark, sf, run=run).select("id", field, ORD)
    return upsert.latest_per_key(raw, "id", ORD)


def _replaced_children(spark, sf, field, flatten):
    target, batch = (flatten(_children(spark, sf, run, field)) for run in (1, 2))
    ids = td.raw_orders(spark, sf, run=2).select(F.col("id").alias("order_id"))
    return upsert.replace_by_key(target, ids, batch, "order_id", spread="id")


def orders_upsert(spark, sf):
    target, batch = (
        upsert.latest_per_key(
            orders.flatten_orders(td.raw_orders(spark, sf, run=run), keep=(ORD,)), "id", ORD
        )
        for run in (1, 2)
    )
    return upsert.replace_by_key(target, batch, batch, "id")


def order_items_replace(spark, sf):
    return _replaced_children(spark, sf, "order_items", orders.flatten_order_items).drop("id")


def payments_replace(spark, sf):
    return _replaced_children(spark, sf, "payments", orders.flatten_payments)


def etl_state_upsert(spark, sf):
    first = _state_after(spark, sf, 1, RUN_1)
    return _state_after(spark, sf, 2, RUN_2, first)


# --- market figures, by our own definitions ---------------------------------


def price_positions(spark, sf):
    return insights.price_positions(enrich_items(spark, sf))


def competitor_ranks(spark, sf):
    return insights.competitor_ranks(enrich_items(spark, sf))


def market_shares(spark, sf):
    return insights.market_shares(orders_flat(spark, sf))


def trend_growth(spark, sf):
    return insights.growth_rates(td.market_trends(spark, sf))


def price_changes(spark, sf):
    runs = []
    for run, as_of in ((1, RUN_1), (2, RUN_2)):
        records = _item_run(spark, sf, run, as_of).select("item_id", "current_price", ORD)
        records = upsert.latest_per_key(records, "item_id", ORD).withColumn(ORD, F.lit(0))
        runs.append(upsert.price_records(records, ORD, as_of, f"run-{run}"))
    return insights.price_changes(runs[0].unionByName(runs[1]))


def sales_velocity(spark, sf):
    raw = td.raw_orders(spark, sf)
    return insights.sales_velocity(orders.flatten_orders(raw), orders.flatten_order_items(raw))


def variant_performance(spark, sf):
    return insights.variant_performance(enrich_items(spark, sf))


def category_segments(spark, sf):
    return insights.category_segments(enrich_items(spark, sf))


# --- whole runs through stored tables --------------------------------------


def _new_folder(spark: SparkSession) -> str:
    """A folder that goes when the session does: the caller still reads what is in it."""
    path = f"{shared_folder(spark)}/tradewind-{uuid.uuid4().hex}"
    Folder(spark, path).delete_at_exit()
    return path


def items_run(spark, sf):
    """Two runs over whole deliveries; some documents are empty, some have no id."""
    store = TableStore(spark, f"{_new_folder(spark)}/tables")
    for run, as_of in ((1, RUN_1), (2, RUN_2)):
        listings, number = td.raw_items(spark, sf, run=run), F.col(ORD)
        without_id = listings.filter(number % 40 == 0).withColumns(
            {"id": F.lit("").cast("string"), ORD: number + td.LATER}
        )
        nothing = listings.filter(number % 60 == 0).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in listings.schema]
        )
        landed = listings.unionByName(without_id).unionByName(nothing)
        run_items(store, landed, f"run-{run}", as_of, ORD)
    return store.read("items")


def orders_run(spark, sf):
    """Batch form, from a parquet landing; returns the order table."""
    folder = _new_folder(spark)
    store = TableStore(spark, f"{folder}/tables")
    for run, as_of in ((1, RUN_1), (2, RUN_2)):
        landing = f"{folder}/landing-{run}"
        td.raw_orders(spark, sf, run=run).write.parquet(landing)
        landed = read_landing(spark, landing, f"{ORD} BIGINT, {schemas.RAW_ORDER}", "parquet")
        run_orders(store, landed, f"run-{run}", as_of, ORD)
        Folder(spark, landing).delete()
    return store.read("orders")


def orders_out_of_order(spark, sf):
    """Three deliveries, the last one loaded first: the last copy of each order is what counts."""
    store = TableStore(spark, f"{_new_folder(spark)}/tables")
    deliveries = td.three_deliveries(spark, sf)
    for n in (2, 0, 1):
        run_orders(store, deliveries[n], f"run-{n}", RUN_1, ORD, across_runs=True)
    lines = store.read("order_items").groupBy(F.col("order_id").alias("id")).agg(
        F.count("*").alias("n_lines")
    )
    found = store.read("orders").select("id", "seller_id", "status", "total_amount")
    return found.join(lines, "id", "left").withColumn("n_lines", F.coalesce("n_lines", F.lit(0)))


def orders_replayed(spark, sf):
    """Three deliveries, of the first two some orders cannot be loaded; a third of those is loaded again in between.

    Of the documents that are loaded again most are corrected.  Returns the orders, the entries that are still
    open and those that were closed.
    """
    store = TableStore(spark, f"{_new_folder(spark)}/tables")
    deliveries, key = td.three_deliveries(spark, sf), F.col(ORD) % td.LATER
    deliveries[0] = deliveries[0].withColumn(
        "currency_id", F.when(key % 5 != 0, F.col("currency_id"))
    )
    deliveries[1] = deliveries[1].withColumn("status", F.when(key % 8 != 0, F.col("status")))
    for n in (0, 1):
        run_orders(store, deliveries[n], f"run-{n}", RUN_1, ORD, across_runs=True)
    number, text = F.col("entry").cast("bigint"), F.col("raw_json")
    missing = F.when(F.col("reason") == "no status", '{"status":"mended",').otherwise('{"currency_id":"BRL",')
    corrected = F.when(number % 7 != 0, F.concat(missing, F.substr(text, F.lit(2))))
    found = store.read("quarantine_open").filter(number % 3 == 1)
    replay_orders(store, "replay", RUN_1, found.select("entry", corrected.alias("document")))
    run_orders(store, deliveries[2], "run-2", RUN_1, ORD, across_runs=True)

    def named(name, key, value, n):
        return store.read(name).select(
            F.lit(name).alias("stored"), F.col(key).alias("id"), F.col(value).alias("value"),
            (F.col(n) if n else F.lit(None)).cast("bigint").alias("n"),
        )

    return (
        named("orders", "id", "status", None)
        .unionByName(named("quarantine_open", "entry", "reason", "n_attempts"))
        .unionByName(named("quarantine_closed", "entry", "closed_by", "n_attempts"))
    )


#: By session and tables: the store after two runs, which two queries read.
_stores: dict[tuple[str, str], TableStore] = {}


def _two_runs(spark, sf):
    """Two order runs, once a session; of the second delivery some orders have no currency."""
    key = spark.sparkContext.applicationId, sf
    if key not in _stores:
        store = TableStore(spark, f"{_new_folder(spark)}/tables")
        for run, as_of in ((1, RUN_1), (2, RUN_2)):
            landed = td.raw_orders(spark, sf, run=run)
            if run == 2:
                currency = F.when(F.col(ORD) % 31 != 0, F.col("currency_id"))
                landed = landed.withColumn("currency_id", currency)
            run_orders(store, landed, f"run-{run}", as_of, ORD)
        _stores[key] = store
    return _stores[key]


def seller_stats_maintained(spark, sf):
    """Statistics after two runs from the counts that the runs keep up to date."""
    store = _two_runs(spark, sf)
    stats = reports.stats_of_days(store.read("order_days"), store.read("etl_state"))
    return stats.select(
        "seller_id",
        F.col("etl_state.status").alias("run_status"),
        F.col("etl_state.total_processed").alias("total_processed"),
        F.col("etl_state.last_run").alias("last_run"),
        F.col("etl_state.last_order_id").alias("last_order_id"),
        F.col("date_range.earliest").alias("earliest"),
        F.col("date_range.latest").alias("latest"),
        F.explode_outer("order_counts").alias("status", "n_orders"),
    )


def orders_run_tables(spark, sf):
    """What two runs leave in the tables of payments and of quarantined orders."""
    store = _two_runs(spark, sf)
    payments = store.read("payments").select(
        F.lit("payments").alias("stored"), "id", "order_id",
        F.col("total_paid_amount").cast("string").alias("value"),
    )
    quarantine = store.read("quarantine").select(
        F.lit("quarantine").alias("stored"), F.lit(None).cast("string").alias("id"),
        F.col("record_id").alias("order_id"), F.col("reason").alias("value"),
    )
    return payments.unionByName(quarantine)


def category_sellers_maintained(spark, sf):
    """Sellers per category after two listing runs, in which listings change category and seller."""
    store = TableStore(spark, f"{_new_folder(spark)}/tables")
    for run, as_of in ((1, RUN_1), (2, RUN_2)):
        run_items(store, td.raw_items(spark, sf, run=run), f"run-{run}", as_of, ORD)
    return rollup.sellers_per_category(store.read("category_sellers"))


def items_run_tables(spark, sf):
    """What two listing runs leave in the tables of price records, sellers and quarantined listings."""
    store = TableStore(spark, f"{_new_folder(spark)}/tables")
    for run, as_of in ((1, RUN_1), (2, RUN_2)):
        listings = td.raw_items(spark, sf, run=run).withColumn(
            "price", F.when(F.col(ORD) % 37 == 0, "on request").otherwise(F.col("price"))
        )
        run_items(store, listings, f"run-{run}", as_of, ORD)

    def named(name, key, value):
        return store.read(name).select(
            F.lit(name).alias("stored"), F.col(key).cast("string").alias("key"),
            F.col(value).cast("string").alias("value"),
        )

    return (
        named("price_history", "item_id", "recorded_at")
        .unionByName(named("sellers", "seller_id", "is_competitor"))
        .unionByName(named("quarantine", "record_id", "reason"))
    )


def orders_pending(spark, sf):
    """Runs for one seller, for another one up to a date, and for all, over one landing with broken lines.

    What a run is not asked for stays pending, so in the end everything is loaded once.
    """
    folder = _new_folder(spark)
    store = TableStore(spark, f"{folder}/tables")
    landing = f"{folder}/landing"
    td.land(td.order_texts(spark, sf), landing, "text")
    for n, asked in enumerate(({"sellers": [td.BIG_SELLER]}, {"sellers": [2, 3], "end": END}, {})):
        run_orders_stream(
            store, landing, f"{folder}/checkpoint", f"run {n}", RUN_1, fmt="json", **asked
        )
    loaded = store.read("orders").select(
        F.lit("orders").alias("stored"), "id", "seller_id", "status"
    )
    null = F.lit(None)
    broken = store.read("quarantine").select(
        F.lit("quarantine").alias("stored"), F.col("raw_json").alias("id"),
        null.cast("bigint").alias("seller_id"), F.col("reason").alias("status"),
    )
    return loaded.unionByName(broken)


def orders_stream(spark, sf):
    """Streaming form, from a JSON landing in several micro-batches; returns the loaded lines.

    The second delivery has the same orders, each first in another status and with some
    defects, then as it was: the last copy counts, wherever the batches were cut.
    """
    folder = _new_folder(spark)
    store = TableStore(spark, f"{folder}/tables")
    landing = f"{folder}/landing"
    for defects, as_of in ((False, RUN_1), (True, RUN_2)):
        seen = len(Folder(spark, landing).names())
        with staging(spark) as stage:
            given = stage.put("given", td.raw_orders(spark, sf, defects=defects).drop(ORD))
            # Eight files a copy at least.
            file_rows = max(1, given.count() // 8)
            for status in (F.lit("early"), F.col("status")):
                td.land(given.withColumn("status", status), landing, "json", file_rows)
        files = len(Folder(spark, landing).names()) - seen
        run_orders_stream(
            store, landing, f"{folder}/checkpoint", f"run {as_of}", as_of,
            files_per_batch=max(4, files // 4),
        )
    lines = store.read("order_items").drop("id")
    status = store.read("orders").select(F.col("id").alias("order_id"), "status")
    return lines.join(status, "order_id")


QUERIES = {
    f.__name__: f
    for f in (
        attr_extract, enrich_items, items_active_limit, items_of_sellers, items_active, item_details,
        item_lookup,
        item_search_page, item_search_indexed, item_pages, items_with_descriptions, items_with_reviews, items_extract,
        item_questions,
        user_lookup, category_trends, price_quarantine,
        sellers_of_category, sellers_quick10, category_seller_counts, seller_outcomes,
        seller_run_summary,
        orders_flat, orders_json, order_tag_counts, order_items_flat, payments_flat, orders_date_range, orders_of_seller,
        orders_new_only, orders_quarantine, orders_unreadable, orders_accepted, payment_conflicts,
        last_two_orders, last_order_documents, orders_by_status, orders_date_span, seller_stats,
        seller_stats_json, order_details, order_lines,
        items_upsert, items_partial_upsert, sellers_upsert, price_history_append, orders_upsert,
        order_items_replace, payments_replace, etl_state_upsert,
        price_positions, competitor_ranks, market_shares, trend_growth, price_changes,
        sales_velocity, variant_performance, category_segments,
        items_run, items_run_tables, category_sellers_maintained, orders_run, orders_run_tables, seller_stats_maintained,
        orders_out_of_order, orders_replayed, orders_pending, orders_stream,
    )
}
