"""Upserts as pure functions: (target, batch) -> new target.

``ord`` names the column that orders records within a batch; the highest wins.
Batches are reduced to one row per key before they meet the target, so both join
sides are unique and a key repeated millions of times is combined map-side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import as_of_literal, is_present
from tradewind.operators.current import current
from tradewind.operators.lookup import match_salted

# Listing fields that an update overwrites, apart from updated_at.
ITEM_MUTABLE = (
    "title", "category_id", "current_price", "original_price", "available_quantity",
    "sold_quantity", "condition", "brand", "size", "color", "gender", "views",
    "conversion_rate", "seller_id",
)
# Seller table column -> field of the listing record.
SELLER_FIELDS = {
    "nickname": "seller_nickname",
    "reputation_score": "seller_reputation",
    "transactions_completed": "seller_transactions",
    "is_competitor": "is_competitor",
    "market_share_pct": "market_share_pct",
}


def latest_per_key(batch: DataFrame, key: str, ord: str) -> DataFrame:
    """The last record of each key, without ``ord``, which is unique."""
    return current(batch.filter(F.col(key).isNotNull()), key, ord).drop(ord)


def with_item_id(records: DataFrame) -> DataFrame:
    """Records that name an item."""
    return records.filter(F.col("item_id") != "")


# --- listings --------------------------------------------------------------


def collapse_items(batch: DataFrame, ord: str) -> DataFrame:
    """One row per item: last record, first ``created_at``, number of records."""
    records = with_item_id(batch)
    present = [c for c in (*ITEM_MUTABLE, "updated_at") if c in batch.columns]
    first_created = (
        F.min_by("created_at", ord) if "created_at" in batch.columns else F.max(F.lit(None))
    )
    return records.groupBy("item_id").agg(
        F.max_by(F.struct(*present), ord).alias("_new"),
        first_created.cast("timestamp_ntz").alias("_created"),
        F.count("*").alias("_n"),
    )


def upsert_items(
    target: DataFrame, batch: DataFrame, ord: str, as_of: str | dt.datetime,
    present: str | None = None,
) -> DataFrame:
    """Insert or update listings by item id.

    A null in a record overwrites; a field the batch does not have at all is left
    alone; ``created_at`` stays as first written.  Column defaults (``views`` 0, load
    times) apply where a key's only record is its insert.  ``present`` names a column that says
    which fields each record has, see ``functions.presence``: then what a record does not have is
    left alone by that record.
    """
    if present is not None:
        return _upsert_partial(target, batch, ord, as_of, present)
    now = as_of_literal(as_of)
    fields = [c for c in ITEM_MUTABLE if c in batch.columns]
    joined = target.withColumn("_old", F.lit(True)).join(
        collapse_items(batch, ord), "item_id", "full_outer"
    )
    is_old, is_new = F.col("_old").isNotNull(), F.col("_n").isNotNull()
    fresh_single = ~is_old & (F.col("_n") == 1)

    def field(name: str) -> Column:
        if name not in fields:
            value = F.col(name)
            insert = F.lit(0).cast("bigint") if name == "views" else F.lit(None)
            return F.when(~is_old, insert).otherwise(value)
        new = F.col(f"_new.{name}")
        if name == "views":
            new = F.when(fresh_single, F.coalesce(new, F.lit(0))).otherwise(new)
        return F.when(is_new, new).otherwise(F.col(name))

    if "updated_at" in batch.columns:
        written = F.col("_new.updated_at")
        updated = F.when(fresh_single, F.coalesce(written, now)).otherwise(written)
    else:
        same = F.lit(True)
        for name in fields:
            same = same & F.col(name).eqNullSafe(F.col(f"_new.{name}"))
        updated = F.when(is_old & same, F.col("updated_at")).otherwise(now)
    return joined.select(
        "item_id",
        *[field(c).alias(c) for c in ITEM_MUTABLE],
        F.when(is_old, F.col("created_at"))
        .otherwise(F.coalesce("_created", now))
        .alias("created_at"),
        F.when(is_new, updated).otherwise(F.col("updated_at")).alias("updated_at"),
    )


#: The fields whose presence counts, in the order of their bits.
ITEM_FIELDS = (*ITEM_MUTABLE, "created_at", "updated_at")


def collapse_partial_items(batch: DataFrame, ord: str, present: str) -> DataFrame:
    """One row per item, with the last record of each field that has it, as (at, value).

    A field that no record has is null.  All of it is combined map-side.
    """
    at = F.col(ord).alias("at")

    def has(name: str) -> Column:
        return is_present(F.col(present), ITEM_FIELDS, name)

    def last(name: str) -> Column:
        return F.max(F.when(has(name), F.struct(at, F.col(name).alias("value")))).alias(f"_{name}")

    first = F.min(F.struct(at, F.when(has("created_at"), F.col("created_at")).alias("created")))
    return with_item_id(batch).groupBy("item_id").agg(
        first.alias("_first"), *[last(c) for c in (*ITEM_MUTABLE, "updated_at")]
    )


def _upsert_partial(
    target: DataFrame, batch: DataFrame, ord: str, as_of: str | dt.datetime, present: str
) -> DataFrame:
    """Each field from the last record that has it.

    ``updated_at`` is the load time if what a record changed came after the last record that
    has the field itself.
    """
    now, names = as_of_literal(as_of), [f.name for f in target.schema]
    missing = [f for f in target.schema if f.name in ITEM_FIELDS and f.name not in batch.columns]
    batch = batch.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    old = target.select("item_id", F.struct(*names[1:]).alias("_old"))
    joined = old.join(collapse_partial_items(batch, ord, present), "item_id", "full_outer")
    is_old, is_new = F.col("_old").isNotNull(), F.col("_first").isNotNull()
    first_at, written = F.col("_first.at"), F.col("_updated_at")

    def field(name: str) -> Column:
        new, before = F.col(f"_{name}"), F.col(f"_old.{name}")
        value = F.when(new.isNotNull(), new["value"]).otherwise(before)
        if name == "views":
            inserted = ~is_old & (new.isNull() | (new["at"] == first_at))
            value = F.when(inserted, F.coalesce(value, F.lit(0))).otherwise(value)
        return value

    changed = F.lit(False)
    for name in ITEM_MUTABLE:
        new = F.col(f"_{name}")
        other = F.when(is_old, ~new["value"].eqNullSafe(F.col(f"_old.{name}"))).otherwise(
            new["at"] > first_at
        )
        after = written.isNull() | (new["at"] > written["at"])
        changed = changed | F.coalesce(new.isNotNull() & other & after, F.lit(False))
    inserted = ~is_old & (written["at"] == first_at)
    updated = (
        F.when(changed | (~is_old & written.isNull()), now)
        .when(inserted, F.coalesce(written["value"], now))
        .when(written.isNotNull(), written["value"])
        .otherwise(F.col("_old.updated_at"))
    )
    return joined.select(
        "item_id",
        *[field(c).alias(c) for c in ITEM_MUTABLE],
        F.when(is_old, F.col("_old.created_at"))
        .otherwise(F.coalesce("_first.created", now))
        .alias("created_at"),
        F.when(is_new, updated).otherwise(F.col("_old.updated_at")).alias("updated_at"),
    )


# --- sellers and state: null does not overwrite ----------------------------


def collapse_non_null(batch: DataFrame, key: str, fields: list[str], ord: str) -> DataFrame:
    """One row per key with the last non-null value of each field."""
    return batch.groupBy(key).agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ord))).alias(c)
            for c in fields
        ]
    )


def upsert_non_null(
    target: DataFrame, batch: DataFrame, key: str, overwrite: tuple[str, ...] = (),
    defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """Full-outer upsert of a collapsed batch; nulls keep the old value.

    ``overwrite`` fields are replaced also by null; ``defaults`` fill new keys.
    """
    fields = [c for c in target.columns if c != key]
    new = batch.select(
        key, F.struct(*[c for c in fields if c in batch.columns]).alias("_new")
    )
    old = target.select(key, F.struct(*fields).alias("_old"))
    joined = old.join(new, key, "full_outer")

    def field(name: str) -> Column:
        old_value = F.col(f"_old.{name}")
        if name not in batch.columns:
            value = old_value
        elif name in overwrite:
            value = F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(old_value)
        else:
            value = F.coalesce(F.col(f"_new.{name}"), old_value)
        if defaults and name in defaults:
            value = F.when(F.col("_old").isNull(), F.coalesce(value, defaults[name])).otherwise(value)
        return value.alias(name)

    return joined.select(key, *[field(c) for c in fields])


def seller_records(batch: DataFrame, ord: str) -> DataFrame:
    """Seller fields of listing records with an item id and a seller id."""
    known = [
        F.col(source).alias(name)
        for name, source in SELLER_FIELDS.items()
        if source in batch.columns
    ]
    records = with_item_id(batch).filter(F.col("seller_id") != 0)
    return records.select("seller_id", *known, F.col(ord).alias("_ord"))


def upsert_sellers(target: DataFrame, batch: DataFrame, ord: str) -> DataFrame:
    """Insert or update sellers named by listing records; only non-null fields count."""
    records = seller_records(batch, ord)
    fields = [c for c in SELLER_FIELDS if c in records.columns]
    if fields:
        collapsed = collapse_non_null(records, "seller_id", fields, "_ord")
    else:
        collapsed = records.select("seller_id").distinct()
    return upsert_non_null(
        target, _with_missing(collapsed, target), "seller_id",
        defaults={"is_competitor": F.lit(False)},
    )


def _with_missing(batch: DataFrame, target: DataFrame) -> DataFrame:
    missing = [f for f in target.schema.fields if f.name not in batch.columns]
    return batch.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def seller_progress(orders: DataFrame, ord: str) -> DataFrame:
    """Orders loaded per seller, and the id of the last one."""
    return orders.groupBy("seller_id").agg(
        F.count("*").alias("total_processed"),
        F.max_by("id", ord).alias("last_order_id"),
    )


def upsert_state(
    target: DataFrame, progress: DataFrame, status: str, as_of: str | dt.datetime
) -> DataFrame:
    """Write one run's outcome per seller; a null last order id keeps the old one."""
    batch = progress.withColumns(
        {
            "last_offset": F.lit(0).cast("bigint"),
            "last_run_date": as_of_literal(as_of),
            "status": F.lit(status),
        }
    )
    return upsert_non_null(
        target, batch, "seller_id",
        overwrite=("last_offset", "total_processed", "last_run_date", "status"),
    )


# --- price history ---------------------------------------------------------


def price_records(batch: DataFrame, ord: str, as_of: str | dt.datetime, run_id: str) -> DataFrame:
    """One price record per listing record, also for repeats and unchanged prices."""
    now = as_of_literal(as_of)

    def optional(name: str, kind: str) -> Column:
        value = F.col(name) if name in batch.columns else F.lit(None)
        return value.cast(kind).alias(name)

    return with_item_id(batch).select(
        F.sha2(F.concat_ws("/", F.lit(run_id), "item_id", F.to_json(F.struct(ord))), 256).alias("id"),
        "item_id",
        F.col("current_price").alias("price"),
        optional("discount_percentage", "double"),
        optional("competitor_rank", "int"),
        optional("price_position", "string"),
        now.alias("recorded_at"),
        now.cast("date").alias("recorded_date"),
    )


# --- orders and their children: whole-row replacement ----------------------


def replace_by_key(
    target: DataFrame, keys: DataFrame, rows: DataFrame, key: str, spread: str | None = None
) -> DataFrame:
    """Target without the keys in ``keys``, plus ``rows``.

    For a table of orders, ``keys`` and ``rows`` are the same batch.  For children,
    ``keys`` are the batch's order ids, including orders that have no rows any more,
    and ``spread`` names a column that varies within an order, as one order may own a
    large share of the target.
    """
    gone = keys.select(key).distinct()
    if spread is None:
        kept = target.join(gone, key, "left_anti")
    else:
        kept = match_salted(target, gone, [key], F.col(spread), "left_anti")
    return kept.unionByName(rows.select(*target.columns))
