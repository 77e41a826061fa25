"""Upserts against a record-by-record model, and their single rules."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.functions import is_present, presence
from tradewind.operators import upsert
from tradewind.sources.landing import empty

from conftest import rows

RUN_1, RUN_2 = dt.datetime(2024, 6, 1), dt.datetime(2024, 6, 2)
RECORD = """
    ord BIGINT, item_id STRING, title STRING, category_id STRING, current_price DOUBLE,
    original_price DOUBLE, available_quantity INT, sold_quantity BIGINT, condition STRING,
    brand STRING, size STRING, color STRING, gender STRING, views BIGINT,
    conversion_rate DOUBLE, seller_id BIGINT, created_at TIMESTAMP_NTZ,
    updated_at TIMESTAMP_NTZ, discount_percentage DOUBLE, seller_nickname STRING,
    seller_reputation DOUBLE, is_competitor BOOLEAN
"""
NAMES = [f.strip().split()[0] for f in RECORD.split(",")]


def batch(spark, records, without=()):
    """Records as a batch in list order; ``without`` names absent fields."""
    numbered = [tuple({**r, "ord": n}.get(c) for c in NAMES) for n, r in enumerate(records)]
    return spark.createDataFrame(numbered, RECORD).drop(*without)


def items(spark, *runs, without=()):
    table = empty(spark, schemas.ITEMS)
    for as_of, records in runs:
        table = upsert.upsert_items(table, batch(spark, records, without), "ord", as_of)
    return {r.item_id: r.asDict() for r in table.collect()}


def model_items(runs, without=()):
    """What storing the records one after the other leads to."""
    table = {}
    for as_of, records in runs:
        for record in records:
            if not record.get("item_id"):
                continue
            given = {c: record.get(c) for c in NAMES if c not in without}
            row = table.get(record["item_id"])
            if row is None:
                row = dict.fromkeys([*upsert.ITEM_MUTABLE, "created_at", "updated_at"])
                row.update({k: v for k, v in given.items() if k in row})
                defaults = {"views": 0, "created_at": as_of, "updated_at": as_of}
                row.update({k: v for k, v in defaults.items() if row[k] is None})
                table[record["item_id"]] = {"item_id": record["item_id"], **row}
            else:
                changes = (*upsert.ITEM_MUTABLE, "updated_at")
                row.update({k: given[k] for k in changes if k in given})
    return table


def random_records(rng, n):
    def maybe(value):
        return None if rng.random() < 0.4 else value

    return [
        {
            "item_id": rng.choice(["a", "b", "c", "d", "e", "", None]),
            "title": maybe(rng.choice("xyz")), "current_price": maybe(rng.random()),
            "views": maybe(rng.randint(0, 9)), "seller_id": rng.choice([None, 0, 1, 2, 3]),
            "brand": maybe("B"), "created_at": maybe(dt.datetime(2020, 1, rng.randint(1, 9))),
            "updated_at": maybe(dt.datetime(2021, 1, rng.randint(1, 9))),
            "seller_nickname": maybe(rng.choice("pqr")), "seller_reputation": maybe(rng.random()),
            "is_competitor": maybe(rng.random() < 0.5),
        }
        for _ in range(n)
    ]


def test_items_equal_the_model(spark):
    rng = random.Random(3)
    for _ in range(6):
        runs = [(as_of, random_records(rng, rng.randint(1, 9))) for as_of in (RUN_1, RUN_2)]
        assert items(spark, *runs) == model_items(runs)


def test_absent_fields_are_left_alone(spark):
    rng = random.Random(4)
    for _ in range(3):
        runs = [(as_of, random_records(rng, 6)) for as_of in (RUN_1, RUN_2)]
        without = ("brand", "views", "created_at")
        assert items(spark, *runs, without=without) == model_items(runs, without)


def lacking(rng, records):
    """Records without some of their fields, each without others."""
    return [{k: v for k, v in r.items() if k == "item_id" or rng.random() < 0.6} for r in records]


def model_partial(runs):
    """Storing records that lack fields one after the other; without the times of updates."""
    table = {}
    for as_of, records in runs:
        for record in records:
            if not record.get("item_id"):
                continue
            row = table.get(record["item_id"])
            if row is None:
                row = table[record["item_id"]] = {
                    c: record.get(c) for c in ("item_id", *upsert.ITEM_MUTABLE, "created_at")
                }
                row["views"] = row["views"] or 0
                row["created_at"] = row["created_at"] or as_of
            else:
                row.update({k: record[k] for k in upsert.ITEM_MUTABLE if k in record})
    return table


def partial(spark, records):
    """The records as a batch with the set of fields that each has."""
    numbered = [{**r, "ord": n} for n, r in enumerate(records)]
    lines = spark.createDataFrame([(json.dumps(r, default=str),) for r in numbered], "value STRING")
    given = F.from_json("value", RECORD).alias("given")
    return lines.select(given, presence(F.col("value"), upsert.ITEM_FIELDS).alias("has")).select(
        "given.*", "has"
    )


def test_partial_records_equal_the_model(spark):
    rng = random.Random(6)
    for _ in range(6):
        runs = [(as_of, lacking(rng, random_records(rng, rng.randint(1, 12)))) for as_of in (RUN_1, RUN_2)]
        table = empty(spark, schemas.ITEMS)
        for as_of, records in runs:
            table = upsert.upsert_items(table, partial(spark, records), "ord", as_of, "has")
        got = {r.item_id: r.asDict() for r in table.drop("updated_at").collect()}
        assert got == model_partial(runs)


def test_whole_records_are_upserted_alike_with_and_without_presence(spark):
    rng = random.Random(7)
    whole = [dict.fromkeys(c for c in NAMES if c != "ord") | r for r in random_records(rng, 12)]
    table, other = empty(spark, schemas.ITEMS), empty(spark, schemas.ITEMS)
    for as_of, records in ((RUN_1, whole[:6]), (RUN_2, whole[6:])):
        table = upsert.upsert_items(table, partial(spark, records), "ord", as_of, "has")
        other = upsert.upsert_items(other, batch(spark, records), "ord", as_of)
    got, expected = ({r.item_id: r.asDict() for r in x.drop("updated_at").collect()} for x in (table, other))
    assert got == expected


def test_times_of_updates_of_partial_records(spark):
    early = dt.datetime(2023, 1, 1)
    first = [{"item_id": k, "title": "x", "updated_at": early} for k in "abcd"] + [{"item_id": "e"}]
    second = [
        {"item_id": "a", "title": "y"}, {"item_id": "b", "title": "x"},
        {"item_id": "c", "title": "y", "updated_at": RUN_1}, {"item_id": "d", "updated_at": None},
    ]
    table = empty(spark, schemas.ITEMS)
    for as_of, records in ((RUN_1, first), (RUN_2, second)):
        table = upsert.upsert_items(table, partial(spark, records), "ord", as_of, "has")
    got = {r.item_id: r.updated_at for r in table.collect()}
    assert got == {"a": RUN_2, "b": early, "c": RUN_1, "d": None, "e": RUN_1}


def test_presence(spark):
    texts = ['{"a": null, "c": 1}', "{}", '["a"]', "x", None, '{"a": {"b": 1}, "a": 2}']
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    bits = presence(F.col("t"), ("a", "b", "c"))
    assert [r[0] for r in df.select(bits).collect()] == [5, 0, None, None, None, 1]
    got = df.select(is_present(bits, ("a", "b", "c"), "c")).first()[0]
    assert got is True


def test_missing_update_time_is_set_when_something_changed(spark):
    first = [{"item_id": k, "title": "x", "views": 1} for k in "abc"]
    second = [{"item_id": "a", "title": "y", "views": 1}, {"item_id": "b", "title": "x", "views": 1}]
    got = items(spark, (RUN_1, first), (RUN_2, second), without=("updated_at",))
    assert [got[k]["updated_at"] for k in "abc"] == [RUN_2, RUN_1, RUN_1]


def test_null_overwrites_items_and_created_at_stays(spark):
    first = [{"item_id": "a", "title": "x", "created_at": RUN_1, "updated_at": RUN_1}]
    second = [{"item_id": "a", "title": None, "created_at": RUN_2, "updated_at": RUN_2}]
    got = items(spark, (RUN_1, first), (RUN_2, second))["a"]
    assert (got["title"], got["created_at"], got["updated_at"]) == (None, RUN_1, RUN_2)


def test_sellers_equal_the_model(spark):
    rng = random.Random(5)
    fields = {"nickname": "seller_nickname", "reputation_score": "seller_reputation",
              "is_competitor": "is_competitor"}
    for _ in range(6):
        model, table = {}, empty(spark, schemas.SELLERS)
        for as_of in (RUN_1, RUN_2):
            records = random_records(rng, rng.randint(1, 9))
            table = upsert.upsert_sellers(table, batch(spark, records), "ord")
            for r in records:
                if r["item_id"] and r["seller_id"]:
                    row = model.setdefault(r["seller_id"], dict.fromkeys(fields))
                    row.update({k: r[f] for k, f in fields.items() if r[f] is not None})
                    row["is_competitor"] = row["is_competitor"] or False
        got = {r.seller_id: {k: r[k] for k in fields} for r in table.collect()}
        assert got == model


def test_sellers_of_records_without_seller_fields(spark):
    plain = batch(spark, [{"item_id": "a", "seller_id": 4}]).drop(
        "seller_nickname", "seller_reputation", "is_competitor"
    )
    got = upsert.upsert_sellers(empty(spark, schemas.SELLERS), plain, "ord")
    assert rows(got) == [(4, None, None, None, False, None)]


def test_history_has_a_row_per_record(spark):
    records = [{"item_id": "a", "current_price": 5.0}] * 2 + [{"item_id": None}, {"item_id": "b"}]
    got = upsert.price_records(batch(spark, records), "ord", RUN_1, "r")
    assert rows(got, "item_id", "price", "recorded_at") == [
        ("a", 5.0, RUN_1), ("a", 5.0, RUN_1), ("b", None, RUN_1)
    ]
    assert got.select("id").distinct().count() == 3
    extra = batch(spark, records).selectExpr("*", "2 AS competitor_rank", "'low' AS price_position")
    got = upsert.price_records(extra, "ord", RUN_1, "r")
    assert rows(got, "competitor_rank", "price_position")[0] == (2, "low")


def test_state_keeps_the_last_order_id(spark):
    schema = "seller_id BIGINT, total_processed BIGINT, last_order_id STRING"
    first = spark.createDataFrame([(1, 5, "o5"), (2, 1, "o1")], schema)
    second = spark.createDataFrame([(1, 0, None)], schema)
    table = upsert.upsert_state(empty(spark, schemas.ETL_STATE), first, "completed", RUN_1)
    table = upsert.upsert_state(table, second, "failed", RUN_2)
    got = rows(table, "seller_id", "total_processed", "last_run_date", "status", "last_order_id")
    assert got == [(1, 0, RUN_2, "failed", "o5"), (2, 1, RUN_1, "completed", "o1")]
    assert table.filter("last_processed_date IS NOT NULL OR last_offset <> 0").isEmpty()


def test_progress(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", 9)],
                               "seller_id BIGINT, id STRING, ord INT")
    assert rows(upsert.seller_progress(df, "ord")) == [(1, 3, "b"), (2, 1, "d")]


def test_replacing_children_of_an_order_without_lines(spark):
    target = spark.createDataFrame([("1", "x"), ("1", "y"), ("2", "z")], "order_id STRING, item STRING")
    keys = spark.createDataFrame([("1",), ("3",)], "order_id STRING")
    new = spark.createDataFrame([("3", "n")], target.schema)
    got = upsert.replace_by_key(target, keys, new, "order_id", spread="item")
    assert rows(got) == [("2", "z"), ("3", "n")]
    assert rows(upsert.replace_by_key(target, keys, new, "order_id")) == rows(got)
