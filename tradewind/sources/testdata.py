"""Landing-shaped views of the given test tables.

The test tables hold no marketplace documents, so these views build them: listings
from parts and events, descriptions from documents, reviews from labels, users from
suppliers, questions from conversations, orders from orders, customers and lines.
Every view covers its whole tables.  A third of all listings and of all orders
belongs to one seller, as a marketplace's largest seller would.

``run`` 1 and 2 give two deliveries of the same table under other ids: run 2 meets
some ids of run 1 again, adds new ones and misses others, and within each run some
ids come twice, so the last delivery has to win.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The busiest seller, and how many keys share each other seller.
BIG_SELLER = 1
PARTS_PER_SELLER = 18
CUSTOMERS_PER_SELLER = 15
SITE = "MLB"
# Line numbers per order document: what is beyond goes into further documents of the order.
LINE_NUMBERS = 64
# A later delivery's orders of arrival are that much higher.
LATER = 10**12
# Documents in a file of a landing at most: one that is packed is read by one task.
FILE_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing_id(key: Column) -> Column:
    return F.concat(F.lit(SITE), F.lpad(key.cast("string"), 12, "0"))


def delivered_key(key: Column, run: int | None) -> Column:
    """Key under which a row is delivered in a run."""
    if run is None:
        return key
    return F.floor(key * 9 / 10) if run == 1 else F.floor(key * 4 / 5) * 2


def _seller(key: Column, group: Column, size: int) -> Column:
    return F.when(key % 3 == 0, F.lit(BIG_SELLER).cast("bigint")).otherwise(
        F.floor(group / size)
    )


def raw_items(spark: SparkSession, sf_dir: str, run: int | None = None) -> DataFrame:
    """Listings, one per part, with views and sales counted from events."""
    part = table(spark, sf_dir, "part")
    counts = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            F.count_if(F.col("event_type") == "view").alias("views"),
            F.count_if(F.col("event_type") == "purchase").alias("sold_quantity"),
        )
    )
    key, list_price = F.col("p_partkey"), F.col("p_retailprice")
    price = list_price * (100 - (key % 6) * 5) / 100
    original = F.when(key % 4 != 0, list_price)
    title = F.col("p_name")
    if run == 2:
        price, original = price * 1.1, F.lit(None).cast("double")
        title = F.when(key % 10 != 0, title)
    return part.join(counts, key == F.col("user_id"), "left").select(
        key.alias("ingest_ordinal"),
        listing_id(delivered_key(key, run)).alias("id"),
        title.alias("title"),
        F.col("p_type").alias("category_id"),
        price.cast("string").alias("price"),
        original.cast("string").alias("original_price"),
        F.col("p_size").alias("available_quantity"),
        "sold_quantity",
        F.when(key % 2 == 0, "new").otherwise("used").alias("condition"),
        "views",
        _seller(key, key, PARTS_PER_SELLER).alias("seller_id"),
        F.when(key % 7 == 0, "paused").otherwise("active").alias("status"),
        F.when(key % 11 != 0, _attributes(key)).alias("attributes"),
    )


def _attributes(key: Column) -> Column:
    def attr(name: str, value_name: Column, value_id: Column) -> Column:
        return F.struct(
            F.lit(name).alias("id"),
            value_name.cast("string").alias("value_name"),
            value_id.cast("string").alias("value_id"),
        )

    null = F.lit(None)
    color = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
    no_color = key % 3 == 0
    return F.array(
        attr("BRAND", F.col("p_brand"), null),
        attr("SIZE", F.when(key % 5 == 0, F.lit("")), F.col("p_size")),
        attr(
            "MAIN_COLOR",
            F.when(no_color, F.lit("")).otherwise(color),
            F.when(no_color, F.lit("")).otherwise(F.lit("c")),
        ),
        attr("MAIN_COLOR", F.lit("never chosen"), F.lit("never chosen")),
    )


def seller_extras(records: DataFrame) -> DataFrame:
    """Listing records with seller fields, of which some sellers have none."""
    known = F.col("seller_id") % 4 == 0
    number = F.col("ingest_ordinal")
    return records.withColumns(
        {
            "seller_nickname": F.when(
                known, F.concat(F.lit("shop-"), F.col("seller_id").cast("string"))
            ),
            "seller_reputation": F.when(known & (number % 2 == 0), number / 8),
            "seller_transactions": F.when(known, number),
            "is_competitor": F.when(F.col("seller_id") % 8 == 0, F.lit(True)),
        }
    )


def record_texts(records: DataFrame, without: dict[str, Column]) -> DataFrame:
    """Records as lines of JSON; a field is absent where ``without`` says so, else null if it is."""
    parts = []
    for name in records.columns:
        pair = F.to_json(F.struct(name), {"ignoreNullFields": "false"})
        inner = F.substring(pair, F.lit(2), F.length(pair) - 2)
        parts.append(F.when(~without[name], inner) if name in without else inner)
    return records.select(
        F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("value")
    )


def moved_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All listings, of which a fifth is delivered again later as the next seller's."""
    first, key = raw_items(spark, sf_dir), F.col("ingest_ordinal")
    again = first.filter(key % 5 == 0).withColumns(
        {"seller_id": F.col("seller_id") + 1, "ingest_ordinal": key + LATER}
    )
    return first.unionByName(again)


def delivered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All listings, a fifth of them delivered again later with another price and status."""
    first, key = raw_items(spark, sf_dir), F.col("ingest_ordinal")
    again = first.filter(key % 5 == 0).withColumns(
        {
            "price": (F.col("price").cast("double") * 2).cast("string"),
            "status": F.when(key % 2 == 0, "paused").otherwise("active"),
            "ingest_ordinal": key + LATER,
        }
    )
    return first.unionByName(again)


def raw_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions, of which a third was delivered in an older version before."""
    text = table(spark, sf_dir, "documents").select(
        listing_id(F.col("doc_id")).alias("item_id"),
        F.col("text").alias("plain_text"),
        F.col("doc_id").alias("ingest_ordinal"),
    )
    stale = text.filter(F.col("ingest_ordinal") % 3 == 0).withColumns(
        {"plain_text": F.lit("stale"), "ingest_ordinal": F.col("ingest_ordinal") - LATER}
    )
    return stale.unionByName(text)


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews, of which a quarter was delivered with a better rating before."""
    rated = table(spark, sf_dir, "labels").select(
        listing_id(F.col("doc_id")).alias("item_id"),
        F.col("quality").cast("double").alias("rating_average"),
        F.col("toxic").cast("bigint").alias("total_reviews"),
        F.col("doc_id").alias("ingest_ordinal"),
    )
    older = rated.filter(F.col("ingest_ordinal") % 4 == 0).withColumns(
        {"rating_average": F.lit(9.0), "ingest_ordinal": F.col("ingest_ordinal") - LATER}
    )
    return older.unionByName(rated)


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user per supplier; accounts in debt show no nickname, and some changed theirs."""
    users = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("nickname"),
        F.lit(SITE).alias("site_id"),
        F.col("s_suppkey").alias("ingest_ordinal"),
    )
    older = users.filter(F.col("id") % 2 == 0).withColumns(
        {"nickname": F.lit("former"), "ingest_ordinal": F.col("ingest_ordinal") - LATER}
    )
    return older.unionByName(users)


def raw_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation is about the listing of its number."""
    return table(spark, sf_dir, "conversations").select(
        listing_id(F.col("conv_id")).alias("item_id"),
        F.col("turn").alias("question_id"),
        "text",
    )


def raw_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.lit(SITE).alias("site_id"),
        F.col("p_type").alias("category_id"),
        F.col("p_name").alias("keyword"),
    )


def market_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search volumes, taken as the lines sold per part name, type and month."""
    lines = table(spark, sf_dir, "lineitem").groupBy(
        "l_partkey", F.trunc("l_shipdate", "month").alias("trend_date")
    ).agg(F.count("*").alias("search_volume"))
    part = table(spark, sf_dir, "part")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_name").alias("keyword"),
        "search_volume",
        F.col("p_type").alias("category_id"),
        "trend_date",
    )


def _shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order the last ship time."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("shipped_order"))
        .agg(F.max("l_shipdate").alias("shipped"))
    )


def _order_lines(
    spark: SparkSession, sf_dir: str, run: int | None, further: bool
) -> DataFrame:
    """The lines of each order, as arrays for a bounded range of line numbers each.

    The first range has a row per order, ``further`` ones one for each more that it fills.
    Run 2 delivers fewer lines than run 1.
    """
    part = table(spark, sf_dir, "part")
    lines = table(spark, sf_dir, "lineitem")
    number = F.col("l_linenumber")
    lines = lines.filter(number > LINE_NUMBERS if further else number <= LINE_NUMBERS)
    if run == 2:
        lines = lines.filter(F.col("l_linenumber") <= 2)

    def money(amount: Column) -> Column:
        return amount.cast("decimal(12,2)").cast("string")

    # What is shuffled are the plain columns; texts are only made of them where the lines of an order lie together.
    line = F.struct(
        F.col("l_linenumber").cast("int").alias("element_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money(F.col("l_extendedprice")).alias("unit_price"),
        money(F.col("p_retailprice")).alias("full_unit_price"),
        F.lit(None).cast("string").alias("sale_fee"),
        F.col("l_returnflag").alias("listing_type_id"),
        F.struct(
            listing_id(F.col("l_partkey")).alias("id"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("category_id"),
            F.when(F.col("l_linestatus") == "O", F.col("l_suppkey"))
            .cast("string")
            .alias("variation_id"),
            F.col("p_brand").alias("seller_sku"),
            F.lit("new").alias("condition"),
            F.lit(None).cast("string").alias("warranty"),
            F.lit(None).cast("string").alias("variation_attributes"),
        ).alias("item"),
    )
    plain = (
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_partkey", "l_suppkey",
        "l_linestatus", "p_name", "p_type", "p_brand", "p_retailprice",
    )
    range_of = F.floor((number - 1) / LINE_NUMBERS).cast("int").alias("part_number")
    return (
        lines.join(part, F.col("l_partkey") == part["p_partkey"])
        .select(*plain)
        .repartition("l_orderkey")
        .select("l_orderkey", number, line.alias("line"))
        .groupBy("l_orderkey", *([range_of] if further else []))
        .agg(F.sort_array(F.collect_list("line")).alias("order_items"))
    )


def raw_orders(
    spark: SparkSession, sf_dir: str, run: int | None = None, defects: bool = False
) -> DataFrame:
    """Order documents.  With ``defects`` some cannot be loaded, for varied reasons.

    An order with very many lines has them in several documents.  Whether there is one is looked up
    first, a scan that skips row groups by their statistics.
    """
    documents = _documents(spark, sf_dir, run, defects, False)
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_linenumber") > LINE_NUMBERS)
    if lines.select("l_orderkey").isEmpty():
        return documents
    return documents.unionByName(_documents(spark, sf_dir, run, defects, True))


def _documents(
    spark: SparkSession, sf_dir: str, run: int | None, defects: bool, further: bool
) -> DataFrame:
    key, total = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    seller = _seller(key, F.col("o_custkey"), CUSTOMERS_PER_SELLER)
    order_id = delivered_key(key, run).cast("string")
    day = F.replace(F.col("o_orderdate").cast("string"), F.lit(" "), F.lit("T"))
    zone = F.when(key % 3 == 0, "-04:00").when(key % 3 == 1, "-03:00").otherwise("Z")
    shipped = F.replace(F.col("shipped").cast("string"), F.lit(" "), F.lit("T"))
    paid = total
    status, currency, payment_key = F.col("o_orderstatus"), F.lit("BRL"), key
    if run == 2:
        status = F.lit("X")
    if defects:
        paid = F.when(key % 29 == 0, "n/a").otherwise(total)
        currency = F.when(key % 31 != 0, currency)
        payment_key = F.when(key % 19 == 0, F.col("o_custkey")).otherwise(key)

    lines = F.col("order_items")
    payments = F.array(
        _payment(payment_key * 10 + 1, "pix", seller, total, day),
        _payment(
            payment_key * 10 + 2, "card", seller,
            F.col("c_acctbal").cast("decimal(12,2)").cast("string"), day,
        ),
    )
    if run is not None:
        payments = F.transform(
            payments,
            lambda p: p.withField("id", F.concat(F.lit(f"{run}-"), p["id"])),
        )
    null_text = F.lit(None).cast("string")
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    # One row per order on the right: a left join whose columns go unused is not run.
    built = orders.join(_shipped(spark, sf_dir), key == F.col("shipped_order"), "left").join(
        _order_lines(spark, sf_dir, run, further),
        key == F.col("l_orderkey"),
        "inner" if further else "left",
    )
    if further:
        order_id = F.concat_ws("-", order_id, F.col("part_number").cast("string"))
    return built.select(
        key.alias("ingest_ordinal"),
        order_id.alias("id"),
        F.struct(seller.alias("id")).alias("seller"),
        F.when(
            key % 13 != 0,
            F.struct(F.col("o_custkey").alias("id"), F.col("c_name").alias("nickname")),
        ).alias("buyer"),
        status.alias("status"),
        F.col("o_orderpriority").alias("status_detail"),
        F.concat(day, F.lit(".000"), zone).alias("date_created"),
        F.when(key % 17 == 0, "garbage")
        .otherwise(F.concat(shipped, F.lit("-04:00")))
        .alias("date_closed"),
        null_text.alias("date_last_updated"),
        null_text.alias("expiration_date"),
        total.alias("total_amount"),
        paid.alias("paid_amount"),
        null_text.alias("shipping_cost"),
        currency.alias("currency_id"),
        null_text.alias("pack_id"),
        (F.col("o_orderstatus") == "F").alias("fulfilled"),
        null_text.alias("comment"),
        F.to_json(F.array("o_orderpriority")).alias("tags"),
        null_text.alias("feedback"),
        F.to_json(F.struct(F.col("c_mktsegment").alias("segment"))).alias("context"),
        lines.alias("order_items"),
        payments.alias("payments"),
    )


def delivered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order documents, a seventh of them delivered again later in another status."""
    first, key = raw_orders(spark, sf_dir), F.col("ingest_ordinal")
    again = first.filter(key % 7 == 0).withColumns(
        {"status": F.lit("again"), "ingest_ordinal": key + LATER}
    )
    return first.unionByName(again)


def three_deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All order documents, half of them again later, a third of them once more after that."""
    first, key = raw_orders(spark, sf_dir), F.col("ingest_ordinal")
    return [first] + [
        first.filter(key % part == 0).withColumns(
            {
                "status": F.lit(status),
                "order_items": F.slice("order_items", 1, part),
                "ingest_ordinal": key + late * LATER,
            }
        )
        for part, status, late in ((2, "second", 1), (3, "third", 2))
    ]


def land(lines: DataFrame, folder: str, fmt: str, file_rows: int = FILE_ROWS) -> None:
    """Add lines to a landing, packed: as plain text the documents take a multiple of the tables."""
    writer = lines.write.mode("append").option("compression", "gzip")
    writer.option("maxRecordsPerFile", min(file_rows, FILE_ROWS)).format(fmt).save(folder)


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents as lines of JSON, of which some are cut off."""
    orders = raw_orders(spark, sf_dir)
    key = F.col("ingest_ordinal")
    text = F.to_json(F.struct(*[c for c in orders.columns if c != "ingest_ordinal"]))
    broken = F.concat(F.lit('{"id": "'), F.col("id"), F.lit('", "seller": {"id": 5'))
    return orders.select(F.when(key % 23 == 0, broken).otherwise(text).alias("value"))


def _payment(number: Column, kind: str, seller: Column, amount: Column, day: Column) -> Column:
    null_text = F.lit(None).cast("string")
    return F.struct(
        number.cast("string").alias("id"),
        F.col("o_custkey").alias("payer_id"),
        F.struct(seller.alias("id")).alias("collector"),
        F.lit("approved").alias("status"),
        null_text.alias("status_detail"),
        F.lit(kind).alias("payment_method_id"),
        F.lit("bank_transfer").alias("payment_type"),
        F.lit("regular_payment").alias("operation_type"),
        amount.alias("transaction_amount"),
        amount.alias("total_paid_amount"),
        null_text.alias("transaction_amount_refunded"),
        F.concat(day, F.lit("-04:00")).alias("date_created"),
        null_text.alias("date_approved"),
        null_text.alias("date_last_modified"),
        F.lit(1).alias("installments"),
        null_text.alias("installment_amount"),
        null_text.alias("issuer_id"),
        null_text.alias("reason"),
        null_text.alias("shipping_cost"),
        null_text.alias("taxes_amount"),
        null_text.alias("coupon_amount"),
    )
