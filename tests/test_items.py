import pytest

from tradewind import schemas
from tradewind.operators import items, reports
from tradewind.sources.landing import point_lookup

from conftest import rows
from documents import land, listing, ordered

AS_OF = "2024-06-01 12:00:00"


@pytest.fixture
def raw(spark, tmp_path):
    def build(*documents):
        return ordered(spark, tmp_path, list(documents), schemas.RAW_ITEM)

    return build


def test_full_listing(raw):
    df = raw(listing(
        "MLB1", category_id="C", price=61.7, original_price=75, available_quantity=3,
        sold_quantity=1148, condition="new", views=15000,
        attributes=[{"id": "BRAND", "value_name": "Marca É"}, {"id": "SIZE", "value_id": "M"},
                    {"id": "COLOR", "value_name": "no"}, {"id": "MAIN_COLOR", "value_name": "Red"},
                    {"id": "GENDER", "value_name": "", "value_id": None}],
    ))
    got = items.enrich(df, AS_OF).first()
    assert len(got) == 18
    assert (got.item_id, got.current_price, got.original_price) == ("MLB1", 61.7, 75.0)
    assert (got.brand, got.size, got.color, got.gender) == ("Marca É", "M", "Red", None)
    assert (got.conversion_rate, got.discount_percentage) == (0.0765, 17.73)
    assert str(got.created_at) == str(got.updated_at) == AS_OF


def test_minimal_listing(raw):
    got = items.enrich(raw({"id": "A", "title": "x"}), AS_OF).first()
    assert (got.current_price, got.original_price, got.views, got.sold_quantity) == (0, 0, 0, 0)
    assert (got.conversion_rate, got.discount_percentage, got.brand) == (0, 0, None)
    assert got.available_quantity is None


@pytest.mark.parametrize(
    "price, original, expected",
    [("61.50", "75.90", (61.5, 75.9)), (None, None, (0, 0)), (45.9, None, (45.9, 45.9)),
     ("", "", (0, 0)), (10, 0, (10, 10))],
)
def test_prices(raw, price, original, expected):
    got = items.enrich(raw(listing("A", price=price, original_price=original)), AS_OF).first()
    assert (got.current_price, got.original_price) == expected


def test_empty_elements_are_dropped(spark, tmp_path):
    df = land(spark, tmp_path / "l", [listing("a"), {}, listing("b")], schemas.RAW_ITEM)
    assert rows(items.enrich(items.drop_empty(df), AS_OF), "item_id") == [("a",), ("b",)]


def test_unreadable_prices_are_split_off(raw):
    good, bad = items.split_by_price(
        raw(listing("a", price="x"), listing("b", original_price="?"), listing("c", price=""),
            listing("d", price="NaN"), listing("e", original_price="-Infinity"))
    )
    assert rows(good, "id") == [("c",)]
    assert rows(bad, "id") == [("a",), ("b",), ("d",), ("e",)]


def test_descriptions_and_reviews(spark, tmp_path, raw):
    df = raw(listing("a"), listing("b"), {"title": "no id"}, listing("c")).select("id", "title")
    texts = spark.createDataFrame([("a", "text", 1), ("c", None, 1)], f"{schemas.RAW_DESCRIPTION}, ord INT")
    got = items.attach_descriptions(df, texts, "ord")
    assert rows(got, "id", "description") == sorted(
        [("a", "text"), ("b", "N/A"), ("c", "N/A"), (None, None)], key=repr
    )
    reviews = spark.createDataFrame([("a", 5.0, 9, 1), ("a", 4.5, 7, 2)], f"{schemas.RAW_REVIEW}, ord INT")
    got = items.attach_reviews(df, reviews, "ord")
    assert rows(got, "id", "rating_average", "total_reviews") == sorted(
        [("a", 4.5, 7), ("b", 0.0, 0), ("c", 0.0, 0), (None, None, None)], key=repr
    )


def test_extract(spark, raw):
    df = raw(listing("a"), listing("b"), listing("c", status="paused"))
    # The last one counts, not the greatest.
    texts = spark.createDataFrame([("a", "zold", 1), ("a", "text", 2)], f"{schemas.RAW_DESCRIPTION}, ord INT")
    reviews = spark.createDataFrame([("b", 4.0, 2, 1)], f"{schemas.RAW_REVIEW}, ord INT")
    assert items.extract(df, "ord", 1).columns == df.columns
    assert rows(items.extract(df, "ord", 1, texts), "id", "description") == [("a", "text")]
    full = items.extract(df, "ord", 9, texts, reviews)
    assert rows(full, "id", "description", "total_reviews") == [("a", "text", 0), ("b", "N/A", 2)]


def test_seller_listings(raw):
    df = raw(
        *[listing(f"a{n}", seller_id=1) for n in range(4)],
        listing("p", seller_id=1, status="paused"), listing("b", seller_id=2),
    )
    order = "ord"
    assert rows(items.seller_listings(df, order, 2), "id") == [("a0",), ("a1",), ("b",)]
    assert rows(items.seller_listings(df, order, 9, "paused"), "id") == [("p",)]
    assert rows(items.seller_listings(df, order, 9, sellers=[2]), "id") == [("b",)]
    for limit, sellers in ((0, None), (-1, None), (5, [])):
        assert items.seller_listings(df, order, limit, sellers=sellers).isEmpty()
    found = items.seller_listings(df.select("id", "seller_id", "status", "ord"), order, 1)
    assert rows(items.with_details(found, df, "ord"), "id", "title") == [("a0", "Thing"), ("b", "Thing")]


def test_only_current_copies_count(spark, raw):
    df = raw(
        listing("a", price=10), listing("b", price=10), listing("c"), listing("n", seller_id=None),
        listing("a", price=99), listing("b", status="paused"), listing("c", title="Ring", category_id="R"),
    )
    assert rows(items.seller_listings(df, "ord", 2), "id", "price") == [("a", "99"), ("c", None), ("n", None)]
    assert rows(items.seller_listings(df, "ord"), "id") == [("a",), ("c",), ("n",)]
    assert rows(items.with_details(df.select("id").distinct(), df, "ord"), "id", "price") == sorted(
        [("a", "99"), ("b", None), ("c", None), ("n", None)], key=repr
    )
    assert rows(items.search(df, "ord", "ring"), "id") == [("c",)]
    assert rows(reports.category_sellers(df, "ord", "R")) == [(5,)]
    texts = spark.createDataFrame(
        [("a", "old", 1), ("a", "new", 2), ("c", "x", 1)], "item_id STRING, plain_text STRING, o INT"
    )
    got = items.attach_descriptions(df.filter("ord < 3").select("id"), texts, "o")
    assert rows(got) == [("a", "new"), ("b", "N/A"), ("c", "x")]
    users = spark.createDataFrame([(5, "old", "M", 1), (5, "new", "M", 2)], "id BIGINT, nickname STRING, site STRING, o INT")
    sellers = spark.createDataFrame([(5,)], "seller_id BIGINT")
    assert rows(reports.with_nicknames(sellers, users, "o")) == [(5, "new")]


def test_a_listing_is_its_last_sellers(raw):
    df = raw(
        listing("a", seller_id=5, price=10), listing("b", seller_id=5), listing("c", seller_id=6),
        listing("a", seller_id=6, price=99), listing("c", seller_id=5), listing(None, seller_id=5),
    )
    assert rows(items.seller_listings(df, "ord", sellers=[5]), "id") == [("b",), ("c",), (None,)]
    assert rows(items.seller_listings(df, "ord", sellers=[6]), "id", "price") == [("a", "99")]
    copies = items.copies_of_sellers(df, [6])
    assert rows(copies, "id", "ord") == [("a", 0), ("a", 3), ("c", 2), ("c", 4)]
    assert items.copies_of_sellers(df, [7]).isEmpty() and items.copies_of_sellers(df, []).isEmpty()


def test_nested_sellers(raw):
    df = items.with_seller(raw(listing("a", seller_id=None, seller={"id": 8}), listing("b", seller_id=3)))
    assert rows(df, "id", "seller_id") == [("a", 8), ("b", 3)]


def test_point_lookup(raw):
    df = raw(listing("a"), listing("b"))
    assert point_lookup(df, "id", "b", ["id"]).collect() == [("b",)]
    for missing in ("zz", "", None):
        assert point_lookup(df, "id", missing).isEmpty()


def test_search(raw):
    df = raw(
        listing("a", title="Blue Ring", category_id="X", seller_id=1),
        listing("b", title="ring 100%", category_id="Y", seller_id=1),
        listing("c", title="Hat", category_id="X", seller_id=2),
    )
    assert rows(items.search(df, "ord", "RING"), "id") == [("a",), ("b",)]
    assert rows(items.search(df, "ord", "0%"), "id") == [("b",)]
    assert rows(items.search(df, "ord", category="X", seller_id=2), "id") == [("c",)]
    assert rows(items.search(df, "ord", limit=1, offset=1), "id") == [("b",)]
    assert rows(items.search(df, "ord", query="", seller_id=0, category=None), "id") == [("a",), ("b",), ("c",)]
    assert items.search(df, "ord", limit=9, offset=3).isEmpty() and items.search(df, "ord", limit=0).isEmpty()


def test_questions_and_trends(spark):
    questions = spark.createDataFrame([("i", n, "q") for n in range(12)], schemas.RAW_QUESTION)
    assert items.item_questions(questions).count() == 12
    got = items.item_questions(questions, limit=10)
    assert rows(got, "question_id", "total") == [(n, 12) for n in range(10)]
    landed = spark.createDataFrame([("MLB", "C", "x"), ("MLB", "D", "y"), ("MLA", "C", "z")], schemas.RAW_TREND)
    assert rows(items.trends(landed, "MLB"), "keyword") == [("x",), ("y",)]
    assert rows(items.trends(landed, "MLB", "C"), "keyword") == [("x",)]


def test_category_sellers(spark, raw):
    df = raw(
        listing("a", seller_id=1, category_id="X"), listing("b", seller_id=1, category_id="X"),
        listing("c", seller_id=0, category_id="X"), listing("d", seller_id=None, category_id="X"),
        listing("e", seller_id=2, category_id="X"), listing("f", seller_id=3, category_id="Y"),
    )
    assert rows(reports.category_sellers(df, "ord", "X")) == [(1,), (2,)]
    assert rows(reports.quick_sellers(df, "ord", "X", 4)) == [(1,)]
    assert rows(reports.count_sellers(df, "ord")) == [("X", 2), ("Y", 1)]
    users = spark.createDataFrame([(1, "shop", "MLB", 1)], f"{schemas.RAW_USER}, ord INT")
    named = reports.with_nicknames(reports.category_sellers(df, "ord", "X"), users, "ord")
    assert rows(named) == [(1, "shop"), (2, "N/A")]
