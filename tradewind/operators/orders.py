"""Order documents: validation, flattening into three tables, date filter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tradewind.functions import (
    as_of_literal,
    hours_between,
    id_or_null,
    not_money,
    to_money,
    wall_clock,
)
from tradewind.operators.lookup import match_salted
from tradewind.sources.landing import CORRUPT

# What a document must carry to be loaded.
REQUIRED_MONEY = ("total_amount", "paid_amount")
OPTIONAL_MONEY = ("shipping_cost",)
LINE_REQUIRED = ("quantity", "unit_price")
LINE_ITEM_REQUIRED = ("id", "title")
LINE_MONEY = ("unit_price", "full_unit_price", "sale_fee")
PAYMENT_REQUIRED = (
    "id", "status", "payment_method_id", "payment_type", "operation_type",
    "transaction_amount", "total_paid_amount",
)
PAYMENT_MONEY = (
    "transaction_amount", "total_paid_amount", "transaction_amount_refunded",
    "installment_amount", "shipping_cost", "taxes_amount", "coupon_amount",
)

REASON = "reject_reason"
SHARED_PAYMENT = "payment id is not unique"


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _bad_line(line: Column) -> Column:
    item = line["item"]
    return _any(
        [line.isNull()]
        + [line[c].isNull() for c in LINE_REQUIRED]
        + [item[c].isNull() for c in LINE_ITEM_REQUIRED]
        + [not_money(line[c]) for c in LINE_MONEY]
    )


def _bad_payment(payment: Column) -> Column:
    return _any(
        [payment.isNull(), payment["collector"]["id"].isNull()]
        + [payment[c].isNull() for c in PAYMENT_REQUIRED]
        + [wall_clock(payment["date_created"]).isNull()]
        + [not_money(payment[c]) for c in PAYMENT_MONEY]
    )


def with_reject_reason(raw: DataFrame) -> DataFrame:
    """Add ``reject_reason``, null for an order that can be loaded.

    An order with an unloadable line or payment is rejected as a whole, so a
    loaded order always has all its children.
    """
    unreadable = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    checks = [
        (unreadable, "unreadable document"),
        (F.col("id").isNull(), "no order id"),
        (F.col("seller.id").isNull(), "no seller id"),
        (F.col("status").isNull(), "no status"),
        (wall_clock(F.col("date_created")).isNull(), "no valid date_created"),
        (F.col("currency_id").isNull(), "no currency"),
    ]
    checks += [(to_money(F.col(c)).isNull(), f"no valid {c}") for c in REQUIRED_MONEY]
    checks += [(not_money(F.col(c)), f"no valid {c}") for c in OPTIONAL_MONEY]
    checks += [
        (F.exists("order_items", _bad_line), "order line cannot be loaded"),
        (F.exists("payments", _bad_payment), "payment cannot be loaded"),
    ]
    return raw.withColumn(REASON, F.coalesce(*[F.when(c, F.lit(why)) for c, why in checks]))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(checked: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Quarantine records of the rejected orders, with the document as it came if unreadable."""
    document = F.to_json(F.struct(*[c for c in checked.columns if c[0] != "_" and c != REASON]))
    if CORRUPT in checked.columns:
        document = F.coalesce(CORRUPT, document)
    return checked.filter(F.col(REASON).isNotNull()).select(
        F.lit("orders").alias("source"),
        F.col("id").alias("record_id"),
        F.col(REASON).alias("reason"),
        document.alias("raw_json"),
        *keep,
    )


def in_date_range(created: Column, start: str | None, end: str | None) -> Column:
    """Inclusive bounds on the wall clock; a bare date as ``end`` is its midnight."""
    conditions = [F.lit(True)]
    if start:
        conditions.append(created >= as_of_literal(start))
    if end:
        conditions.append(created <= as_of_literal(end))
    return reduce(lambda a, b: a & b, conditions)


def orders_in_range(raw: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Order documents created within the bounds; all of them without bounds."""
    return raw.filter(in_date_range(wall_clock(F.col("date_created")), start, end))


def of_sellers(raw: DataFrame, sellers: list[int] | None) -> Column:
    """Whether a document is of some sellers (``None``: all); an unreadable one might be."""
    if sellers is None:
        return F.lit(True)
    own = F.coalesce(F.col("seller.id").isin(sellers), F.lit(False)) if sellers else F.lit(False)
    return own | F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else own


def for_sellers(raw: DataFrame, sellers: list[int] | None) -> DataFrame:
    """Order documents of some sellers, and unreadable ones; ``None`` means all."""
    return raw if sellers is None else raw.filter(of_sellers(raw, sellers))


def asked_for(
    raw: DataFrame, sellers: list[int] | None, start: str | None, end: str | None
) -> Column:
    """Whether a run over some sellers and times has to load a document; never null.

    A time that cannot be read is not out of range: the document is loaded, to be quarantined.
    """
    created = wall_clock(F.col("date_created"))
    return of_sellers(raw, sellers) & (created.isNull() | in_date_range(created, start, end))


def unseen(raw: DataFrame, seen_ids: DataFrame) -> DataFrame:
    """Order documents whose id is not in ``seen_ids`` (column ``id``).

    Either side may repeat an id any number of times.  Copies are spread by what they say,
    so that a task that runs again sends them to the same place.
    """
    known = seen_ids.select("id").distinct()
    nested = (ArrayType, MapType, StructType)
    says = [f.name for f in raw.schema if f.name != "id" and not isinstance(f.dataType, nested)]
    return match_salted(raw, known, ["id"], F.struct(*says), "left_anti")


def flatten_orders(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per order document."""
    created, closed = wall_clock(F.col("date_created")), wall_clock(F.col("date_closed"))
    return raw.select(
        F.col("id").cast("string").alias("id"),
        F.col("seller.id").alias("seller_id"),
        F.col("buyer.id").alias("buyer_id"),
        F.col("buyer.nickname").alias("buyer_nickname"),
        "status",
        "status_detail",
        created.alias("date_created"),
        closed.alias("date_closed"),
        wall_clock(F.col("date_last_updated")).alias("date_last_updated"),
        wall_clock(F.col("expiration_date")).alias("expiration_date"),
        to_money(F.col("total_amount")).alias("total_amount"),
        to_money(F.col("paid_amount")).alias("paid_amount"),
        "currency_id",
        to_money(F.col("shipping_cost")).alias("shipping_cost"),
        "pack_id",
        "fulfilled",
        "comment",
        "tags",
        F.col("feedback").alias("feedback_data"),
        F.col("context").alias("context_data"),
        hours_between(created, closed).alias("processing_time_hours"),
        *keep,
    )


def flatten_order_items(raw: DataFrame) -> DataFrame:
    """One row per order line; the key is derived from order and position."""
    lines = raw.select(F.col("id").alias("order_id"), F.posexplode("order_items"))
    line, item = F.col("col"), F.col("col.item")
    return lines.select(
        F.concat_ws("/", "order_id", F.col("pos").cast("string")).alias("id"),
        "order_id",
        line["element_id"].alias("element_id"),
        item["id"].alias("item_id"),
        item["title"].alias("title"),
        item["category_id"].alias("category_id"),
        id_or_null(item["variation_id"]).alias("variation_id"),
        item["seller_sku"].alias("seller_sku"),
        line["quantity"].alias("quantity"),
        to_money(line["unit_price"]).alias("unit_price"),
        to_money(line["full_unit_price"]).alias("full_unit_price"),
        to_money(line["sale_fee"]).alias("sale_fee"),
        line["listing_type_id"].alias("listing_type_id"),
        item["condition"].alias("condition"),
        item["warranty"].alias("warranty"),
        item["variation_attributes"].alias("variation_attributes"),
    )


def flatten_payments(raw: DataFrame) -> DataFrame:
    """One row per payment."""
    payment = F.col("payment")
    return raw.select(F.col("id").alias("order_id"), F.explode("payments").alias("payment")).select(
        payment["id"].alias("id"),
        "order_id",
        payment["payer_id"].alias("payer_id"),
        payment["collector"]["id"].alias("collector_id"),
        payment["status"].alias("status"),
        payment["status_detail"].alias("status_detail"),
        payment["payment_method_id"].alias("payment_method_id"),
        payment["payment_type"].alias("payment_type"),
        payment["operation_type"].alias("operation_type"),
        to_money(payment["transaction_amount"]).alias("transaction_amount"),
        to_money(payment["total_paid_amount"]).alias("total_paid_amount"),
        to_money(payment["transaction_amount_refunded"]).alias("transaction_amount_refunded"),
        wall_clock(payment["date_created"]).alias("date_created"),
        wall_clock(payment["date_approved"]).alias("date_approved"),
        wall_clock(payment["date_last_modified"]).alias("date_last_modified"),
        payment["installments"].alias("installments"),
        to_money(payment["installment_amount"]).alias("installment_amount"),
        payment["issuer_id"].alias("issuer_id"),
        payment["reason"].alias("reason"),
        to_money(payment["shipping_cost"]).alias("shipping_cost"),
        to_money(payment["taxes_amount"]).alias("taxes_amount"),
        to_money(payment["coupon_amount"]).alias("coupon_amount"),
    )


def clashing_payments(uses: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Payment ids that more than one payment has.

    ``uses`` has one row (``payment_id``, ``order_id``) per payment of a batch, and
    ``stored`` such rows of the table.  An id stored under another order clashes even
    if that order is in the batch too: its new version might itself be held back.
    """
    counts = uses.groupBy("payment_id").agg(
        F.count("*").alias("_n"), F.min("order_id").alias("_user")
    )
    clashes = counts.filter(F.col("_n") > 1).select("payment_id")
    if stored is None:
        return clashes
    taken = stored.join(counts, "payment_id").filter(F.col("order_id") != F.col("_user"))
    return clashes.union(taken.select("payment_id")).distinct()


def payments_among(uses: DataFrame, clashes: DataFrame) -> DataFrame:
    """The rows of ``uses`` whose payment id is among the clashing ones."""
    return match_salted(uses, clashes, ["payment_id"], F.col("order_id"), "left_semi")


def shared_payments(uses: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Ids of the batch's orders with a payment id that another payment also has."""
    return payments_among(uses, clashing_payments(uses, stored)).select("order_id").distinct()


def order_details(orders: DataFrame, lines: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with the count and sums of their lines and payments.

    Children are summed per order before the joins, so both join sides have one
    row per order and a huge order is combined map-side.
    """
    amount = F.col("unit_price") * F.col("quantity")
    per_line = lines.groupBy("order_id").agg(
        F.count("*").alias("n_lines"),
        F.sum(F.col("quantity").cast("long")).alias("units"),
        F.sum(amount.cast("decimal(18,2)")).alias("lines_amount"),
    )
    per_payment = payments.groupBy("order_id").agg(
        F.count("*").alias("n_payments"),
        F.sum("total_paid_amount").alias("payments_amount"),
    )
    return (
        orders.withColumnRenamed("id", "order_id")
        .join(per_line, "order_id", "left")
        .join(per_payment, "order_id", "left")
        .withColumns(
            {
                "n_lines": F.coalesce("n_lines", F.lit(0)),
                "n_payments": F.coalesce("n_payments", F.lit(0)),
            }
        )
    )


def order_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders joined to their lines, one row per line."""
    head = orders.select(F.col("id").alias("order_id"), "seller_id", "status", "date_created")
    return head.join(lines.drop("id"), "order_id")
