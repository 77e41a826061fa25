"""Whole runs through stored tables, batch and streaming."""

import itertools
import json
import os
import random
from decimal import Decimal

import pytest

from tradewind import schemas
from tradewind.operators import reports, rollup
from tradewind.operators.orders import orders_in_range
from tradewind.plans import orders_run as order_plan
from tradewind.operators.upsert import ITEM_FIELDS
from tradewind.plans.items_run import run_items, run_records
from tradewind.plans.orders_run import run_orders
from tradewind.plans.tables import TableStore
from tradewind.sources.landing import (
    ARRIVAL,
    PRESENT,
    read_landing,
    read_records,
    with_arrival,
)
from tradewind.streaming.orders_stream import run_orders_stream

from conftest import plan, rows
from documents import land, line, listing, order, ordered, payment

RUN_1, RUN_2, RUN_3 = "2024-06-01 12:00:00", "2024-06-02 12:00:00", "2024-06-03 12:00:00"


def load_items(spark, store, tmp_path, run, as_of, documents, **kw):
    raw = ordered(spark, tmp_path, documents, schemas.RAW_ITEM, run)
    return run_items(store, raw, run, as_of, "ord", **kw)


def test_item_run(spark, store, tmp_path):
    first = [listing("a", price=5, seller_id=1), listing("b", price="x", seller_id=2),
             listing("a", price=6, seller_id=1), listing(None, price=1, seller_id=3),
             listing("c", price=7, seller_id=0), listing("d", price=1, seller_id=4, status="paused")]
    outcome = load_items(spark, store, tmp_path, "r1", RUN_1, first)
    assert rows(outcome, "seller_id", "success") == [
        (0, True), (1, True), (2, False), (3, False), (4, False)
    ]
    again = load_items(spark, store, tmp_path, "r1", RUN_2, first)
    assert rows(again) == rows(outcome)
    assert rows(store.read("items"), "item_id", "current_price") == [("a", 6.0), ("c", 7.0)]
    assert rows(store.read("price_history"), "item_id", "price") == [("a", 6.0), ("c", 7.0)]
    assert rows(store.read("sellers"), "seller_id", "is_competitor") == [(1, False)]
    bad = store.read("quarantine").first()
    assert (bad.source, bad.record_id, json.loads(bad.raw_json)["price"]) == ("items", "b", "x")

    load_items(spark, store, tmp_path, "r2", RUN_2, [listing("a", price=8, seller_id=1)])
    got = store.read("items").filter("item_id = 'a'").first()
    assert (got.current_price, str(got.created_at), str(got.updated_at)) == (8.0, RUN_1, RUN_2)
    assert store.read("price_history").count() == 3


def test_item_run_of_some_sellers(spark, store, tmp_path):
    documents = [listing(f"a{n}", seller_id=1) for n in range(3)] + [listing("b", seller_id=2)]
    outcome = load_items(spark, store, tmp_path, "r", RUN_1, documents, sellers=[1, 9], limit=2)
    assert rows(outcome) == [(1, 2, True), (9, 0, False)]
    assert rows(store.read("items"), "item_id") == [("a0",), ("a1",)]


def test_item_run_of_a_seller_takes_its_listings_as_they_are_now(spark, store, tmp_path):
    documents = [
        listing("a", price=10, seller_id=5), listing("b", price=20, seller_id=5),
        listing("a", price=99, seller_id=6), listing("c", price="x", seller_id=6),
        listing("d", price="y", seller_id=5),
    ]
    outcome = load_items(spark, store, tmp_path, "r", RUN_1, documents, sellers=[5])
    assert rows(outcome) == [(5, 1, True)]
    assert rows(store.read("items"), "item_id", "current_price") == [("b", 20.0)]
    assert rows(store.read("quarantine"), "record_id") == [("d",)]
    load_items(spark, store, tmp_path, "r6", RUN_2, documents, sellers=[6])
    assert rows(store.read("items"), "item_id", "current_price") == [("a", 99.0), ("b", 20.0)]


def test_records_that_lack_fields(spark, store, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [
        '{"item_id": "a", "title": "x", "current_price": 5, "views": 7, "seller_id": 3}',
        '{"item_id": "a", "title": null, "updated_at": "2024-01-01 00:00:00"}', '{"item_id"', "[]",
    ]
    (tmp_path / "in" / "x.json").write_text("\n".join(lines))
    raw = with_arrival(read_records(spark, str(tmp_path / "in"), schemas.RECORD, ITEM_FIELDS))
    assert run_records(store, raw, "r", RUN_1, ARRIVAL, PRESENT)
    assert not run_records(store, raw, "r", RUN_1, ARRIVAL, PRESENT)
    got = store.read("items").first()
    assert (got.item_id, got.title, got.current_price, got.views) == ("a", None, 5.0, 7)
    assert (str(got.created_at), str(got.updated_at)) == (RUN_1, "2024-01-01 00:00:00")
    assert rows(store.read("price_history"), "price") == [(5.0,), (None,)]
    assert rows(store.read("sellers"), "seller_id") == [(3,)]
    assert rows(store.read("quarantine"), "raw_json") == [("[]",), ('{"item_id"',)]


def load_orders(spark, store, tmp_path, run, as_of, documents, **kw):
    raw = ordered(spark, tmp_path, documents, name=run)
    return run_orders(store, raw, run, as_of, "ord", **kw)


def state(store):
    return {r.seller_id: (r.status, r.total_processed, r.last_order_id) for r in store.read("etl_state").collect()}


def test_order_run(spark, store, tmp_path):
    first = [order("1", order_items=[line(), line(quantity=2)]), order("2"), order("3", status=None),
             order("2", paid_amount="99"), order("4", seller=6)]
    assert load_orders(spark, store, tmp_path, "r1", RUN_1, first)
    assert not load_orders(spark, store, tmp_path, "r1", RUN_1, first)
    assert rows(store.read("orders"), "id", "paid_amount") == [
        ("1", Decimal("10.00")), ("2", Decimal("99.00")), ("4", Decimal("10.00"))
    ]
    assert rows(store.read("order_items"), "order_id") == [("1",), ("1",), ("2",), ("4",)]
    assert rows(store.read("payments"), "id") == [("p-1",), ("p-2",), ("p-4",)]
    assert rows(store.read("quarantine"), "record_id", "reason") == [("3", "no status")]
    assert state(store) == {5: ("completed", 2, "2"), 6: ("completed", 1, "4")}

    load_orders(spark, store, tmp_path, "r2", RUN_2, [order("1", status=None), order("1", order_items=None, payments=None)])
    assert rows(store.read("order_items"), "order_id") == [("2",), ("4",)]
    assert rows(store.read("payments"), "id") == [("p-2",), ("p-4",)]
    assert state(store) == {5: ("completed", 1, "1"), 6: ("completed", 1, "4")}


def test_shared_payment_ids_are_quarantined(spark, store, tmp_path):
    load_orders(spark, store, tmp_path, "r1", RUN_1, [order("1"), order("2")])
    load_orders(spark, store, tmp_path, "r2", RUN_2, [
        order("3", payments=[payment("p-1")]),   # belongs to stored order 1
        order("4", payments=[payment("p-2")]),   # order 2 gives it up only now
        order("2", payments=[payment("new"), payment("p-2b")]),
        order("5", payments=[payment("x")]), order("6", payments=[payment("x")]),
    ])
    assert rows(store.read("orders"), "id") == [("1",), ("2",)]
    assert rows(store.read("payments"), "id", "order_id") == [
        ("new", "2"), ("p-1", "1"), ("p-2b", "2")
    ]
    assert rows(store.read("quarantine"), "record_id") == [("3",), ("4",), ("5",), ("6",)]
    load_orders(spark, store, tmp_path, "r3", RUN_3, [
        order("4", payments=[payment("p-2")]), order("2", payments=[payment("new")])
    ])
    assert rows(store.read("payments"), "id", "order_id") == [("new", "2"), ("p-1", "1"), ("p-2", "4")]


def test_random_batches_equal_a_model(spark, store, tmp_path):
    rng = random.Random(12)
    stored, held_back = {}, 0
    for run in range(4):
        batch = []
        for n in range(10):
            pays = [payment(rng.choice(["x", "y", f"{run}{n}a"])) for _ in range(rng.randint(0, 2))]
            lines = [line(item={"id": rng.choice("ab")}) for _ in range(rng.randint(0, 3))]
            document = order(rng.choice("abcdefgh"), status=rng.choice(["paid", "paid", "new", None]),
                             order_items=lines or None, payments=pays or None)
            batch.append(document)
        load_orders(spark, store, tmp_path, f"r{run}", RUN_1, batch)

        held_back += sum(d["status"] is None for d in batch)
        last = {d["id"]: d for d in batch if d["status"]}
        uses = [(p["id"], d["id"]) for d in last.values() for p in d["payments"] or []]
        taken = {p["id"]: k for k, d in stored.items() for p in d["payments"] or []}
        clashing = {
            o for p, o in uses if sum(p == q for q, _ in uses) > 1 or taken.get(p, o) != o
        }
        held_back += len(clashing)
        stored.update({k: d for k, d in last.items() if k not in clashing})

        assert rows(store.read("orders"), "id", "status") == sorted(
            (k, d["status"]) for k, d in stored.items()
        )
        assert rows(store.read("order_items"), "order_id", "item_id") == sorted(
            (k, x["item"]["id"]) for k, d in stored.items() for x in d["order_items"] or []
        )
        assert rows(store.read("payments"), "order_id", "id") == sorted(
            (k, p["id"]) for k, d in stored.items() for p in d["payments"] or []
        )
        assert store.read("quarantine").count() == held_back
        assert rows(store.read("payment_owners")) == rows(store.read("payments"), "id", "order_id")
    assert held_back > 8


def test_date_bounds_and_sellers(spark, store, tmp_path):
    documents = [order("1"), order("2", date_created="2024-02-01"), order("3", seller=6),
                 order("4", date_created="x"), order("5", date_created="2024-02-01", status=None)]
    load_orders(spark, store, tmp_path, "r", RUN_1, documents, end="2024-01-31", sellers=[5, 7])
    assert rows(store.read("orders"), "id") == [("1",)]
    assert rows(store.read("quarantine"), "record_id") == [("4",)]
    assert state(store) == {5: ("completed", 1, "1"), 7: ("completed", 0, None)}


def test_failure_is_recorded_and_the_run_can_be_repeated(spark, store, tmp_path, monkeypatch):
    load_orders(spark, store, tmp_path, "r1", RUN_1, [order("1")])
    with monkeypatch.context() as patch:
        patch.setattr(order_plan, "flatten_payments", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_orders(spark, store, tmp_path, "r2", RUN_2, [order("2")], sellers=[5])
    assert state(store) == {5: ("failed", 0, "1")}
    load_orders(spark, store, tmp_path, "r2", RUN_2, [order("2")], sellers=[5])
    assert state(store) == {5: ("completed", 1, "2")}


def test_after_a_pause_known_orders_are_skipped(spark, store, tmp_path, monkeypatch):
    load_orders(spark, store, tmp_path, "r1", RUN_1, [order("1"), order("9", seller=6)])
    with monkeypatch.context() as patch:
        def interrupt(df):
            raise KeyboardInterrupt

        patch.setattr(order_plan, "flatten_payments", interrupt)
        with pytest.raises(KeyboardInterrupt):
            load_orders(spark, store, tmp_path, "r2", RUN_2, [order("2")], sellers=[5])
    assert state(store)[5] == ("paused", 0, "1")
    changed = [order("1", status="changed"), order("2"), order("9", seller=6, status="changed")]
    load_orders(spark, store, tmp_path, "r3", RUN_3, changed)
    assert rows(store.read("orders"), "id", "status") == [("1", "paid"), ("2", "paid"), ("9", "changed")]


# --- streaming -------------------------------------------------------------

TABLES = ("orders", "order_items", "payments")


def content(store):
    return {name: rows(store.read(name)) for name in TABLES}


def test_stream_equals_batch(spark, tmp_path):
    landing = tmp_path / "in"
    documents = [order(str(n), seller=n % 3 + 1, order_items=[line()] * (n % 3)) for n in range(20)]
    documents.append(order("bad", currency_id=None))
    land(spark, landing, documents)
    stream, batch = (TableStore(spark, str(tmp_path / k)) for k in ("stream", "batch"))
    run_orders_stream(stream, str(landing), str(tmp_path / "cp"), "s1", RUN_1)
    raw = with_arrival(read_landing(spark, str(landing), schemas.RAW_ORDER))
    run_orders(batch, raw, "b1", RUN_1, ARRIVAL)
    assert content(stream) == content(batch) and len(content(stream)["orders"]) == 20
    assert state(stream) == state(batch)
    assert rows(stream.read("quarantine")) == rows(batch.read("quarantine"))


def test_stream_takes_new_files_and_replays_nothing(spark, store, tmp_path):
    landing, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    land(spark, landing, [order("1", order_items=[line(), line()]), order("2")], name="a")
    run_orders_stream(store, str(landing), checkpoint, "s1", RUN_1)
    first = content(store)
    run_orders_stream(store, str(landing), checkpoint, "s2", RUN_2)
    assert content(store) == first
    land(spark, landing, [order("1", status="changed", order_items=[line()]), order("3")], name="b")
    run_orders_stream(store, str(landing), checkpoint, "s3", RUN_3)
    assert rows(store.read("orders"), "id", "status") == [("1", "changed"), ("2", "paid"), ("3", "paid")]
    assert rows(store.read("order_items"), "order_id") == [("1",), ("2",), ("3",)]
    assert state(store) == {5: ("completed", 2, "3")}


@pytest.mark.parametrize("files_per_batch", [1, 2, 1000])
def test_stream_results_do_not_depend_on_the_batches(spark, store, tmp_path, files_per_batch):
    landing = tmp_path / "in"
    deliveries = (
        [order("1", status="new"), order("2"), order("2", status="later copy")],
        [order("1", status="cancelled"), order("3")],
        [order("4"), order("3", order_items=[line(), line()], status="again")],
    )
    for n, documents in enumerate(deliveries):
        land(spark, landing, documents, name=f"f{n}")
        os.utime(landing / f"f{n}.json", (n + 1, n + 1))
    run_orders_stream(
        store, str(landing), str(tmp_path / "cp"), "s", RUN_1, files_per_batch=files_per_batch
    )
    assert rows(store.read("orders"), "id", "status") == [
        ("1", "cancelled"), ("2", "later copy"), ("3", "again"), ("4", "paid")
    ]
    assert store.read("order_items").count() == 5
    assert state(store) == {5: ("completed", 4, "3")}


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_after_a_pause_a_stream_skips_known_orders_in_all_batches(spark, store, tmp_path, files_per_batch, monkeypatch):
    load_orders(spark, store, tmp_path, "r1", RUN_1, [order("1"), order("2")])
    with monkeypatch.context() as patch:
        def interrupt(df):
            raise KeyboardInterrupt

        patch.setattr(order_plan, "flatten_payments", interrupt)
        with pytest.raises(KeyboardInterrupt):
            load_orders(spark, store, tmp_path, "r2", RUN_2, [order("3")], sellers=[5])
    for n in "12":
        land(spark, tmp_path / "in", [order(n, status="upd"), order(f"9{n}", payments=None)], name=n)
    run_orders_stream(
        store, str(tmp_path / "in"), str(tmp_path / "cp"), "s", RUN_3, files_per_batch=files_per_batch
    )
    assert rows(store.read("orders"), "id", "status") == [
        ("1", "paid"), ("2", "paid"), ("91", "paid"), ("92", "paid")
    ]


def test_a_new_checkpoint_at_an_old_path_loses_nothing(spark, store, tmp_path):
    checkpoint = tmp_path / "cp"
    land(spark, tmp_path / "in", [order("1")])
    run_orders_stream(store, str(tmp_path / "in"), str(checkpoint), "s1", RUN_1)
    checkpoint.rename(tmp_path / "old")
    land(spark, tmp_path / "in2", [order("2")])
    assert run_orders_stream(store, str(tmp_path / "in2"), str(checkpoint), "s2", RUN_2)
    assert rows(store.read("orders"), "id") == [("1",), ("2",)]


def test_unreadable_listings_are_quarantined(spark, store, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ['{"id": "a", "seller_id": 5, "status": "active", "price": 3}', '{"id": "b", "sell', "{}"]
    (tmp_path / "in" / "x.json").write_text("\n".join(lines))
    raw = with_arrival(read_landing(spark, str(tmp_path / "in"), schemas.RAW_ITEM))
    run_items(store, raw, "r", RUN_1, ARRIVAL)
    assert rows(store.read("items"), "item_id") == [("a",)]
    assert rows(store.read("quarantine"), "reason", "raw_json") == [("unreadable document", lines[1])]


def test_redelivered_batch_changes_nothing(spark, store, tmp_path):
    landing, checkpoint = tmp_path / "in", tmp_path / "cp"
    land(spark, landing, [order("1")])
    run_orders_stream(store, str(landing), str(checkpoint), "s1", RUN_1)
    # The stream died after loading, before it noted the batch as done.
    for note in (checkpoint / "commits").iterdir():
        note.unlink()
    before = content(store), store.read("quarantine").count()
    run_orders_stream(store, str(landing), str(checkpoint), "s2", RUN_2)
    assert (content(store), store.read("quarantine").count()) == before


def test_failed_stream_can_be_continued(spark, store, tmp_path, monkeypatch):
    landing, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    land(spark, landing, [order("1"), order("2", seller=6)])
    with monkeypatch.context() as patch:
        patch.setattr(order_plan, "flatten_payments", lambda df: 1 / 0)
        with pytest.raises(Exception, match="division by zero"):
            run_orders_stream(store, str(landing), checkpoint, "s", RUN_1, sellers=[5])
    assert state(store) == {5: ("failed", 0, None)} and store.read("orders").isEmpty()
    run_orders_stream(store, str(landing), checkpoint, "s", RUN_2, sellers=[5])
    assert state(store) == {5: ("completed", 1, "1")}
    land(spark, landing, [order("3")], name="more")
    run_orders_stream(store, str(landing), checkpoint, "s3", RUN_3, sellers=[5])
    assert state(store) == {5: ("completed", 1, "3")}
    assert rows(store.read("orders"), "id") == [("1",), ("3",)]
    # The other seller's order was left for whoever asks for it.
    assert run_orders_stream(store, str(landing), checkpoint, "s4", RUN_3, sellers=[6])
    assert rows(store.read("orders"), "id") == [("1",), ("2",), ("3",)]
    assert not run_orders_stream(store, str(landing), checkpoint, "s5", RUN_3)


BROKEN = '{"id": "x", "seller": {"id": 5'


def land_for_runs(spark, landing):
    """Two files with orders of three sellers, copies of some, and lines that cannot be read."""
    first = [order(str(n), seller=n % 3 + 1, date_created=f"2024-0{n % 4 + 1}-15") for n in range(12)]
    again = [order(str(n), seller=n % 3 + 1, status="again", date_created="2024-01-20") for n in range(0, 12, 2)]
    odd = [order("u", seller=None), order("v", seller=2, date_created="x"), order("w", seller=1, status=None)]
    for n, documents in enumerate((first, again + odd)):
        land(spark, landing, documents, name=f"f{n}")
        with open(landing / f"f{n}.json", "a") as file:
            file.write(f"{BROKEN}{n}\n")
        os.utime(landing / f"f{n}.json", (n + 1, n + 1))


@pytest.mark.parametrize(
    "asked",
    [
        [{"sellers": [1]}, {"sellers": [2]}, {}],
        [{"sellers": [3], "end": "2024-02-01"}, {"start": "2024-04-01"}, {"sellers": [3, 9]}, {}],
        [{"end": "2024-01-31"}, {"sellers": []}, {"sellers": [1, 2]}, {"sellers": [3]}, {}],
    ],
)
def test_runs_for_some_lose_nothing(spark, tmp_path, asked):
    landing = tmp_path / "in"
    land_for_runs(spark, landing)
    whole, parts = (TableStore(spark, str(tmp_path / k)) for k in ("whole", "parts"))
    run_orders_stream(whole, str(landing), str(tmp_path / "cp1"), "s", RUN_1)
    for n, bounds in enumerate(asked):
        run_orders_stream(parts, str(landing), str(tmp_path / "cp2"), f"s{n}", RUN_1, **bounds)
        loaded = {r.seller_id for r in parts.read("orders").select("seller_id").collect()}
        if n == 0 and bounds.get("sellers"):
            assert loaded == set(bounds["sellers"])
    assert content(parts) == content(whole)
    for name in ("quarantine", "order_arrivals", "order_days"):
        assert rows(parts.read(name)) == rows(whole.read(name))
    assert whole.read("quarantine").count() == 5
    assert not run_orders_stream(parts, str(landing), str(tmp_path / "cp2"), "more", RUN_1)
    assert parts.current()["pending"] == {}


def test_a_run_for_a_seller_reads_its_part_only(spark, store, tmp_path, monkeypatch):
    from tradewind.streaming import orders_stream

    landing, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    land(spark, landing, [order(str(n), seller=n) for n in range(1, 41)])
    run_orders_stream(store, str(landing), checkpoint, "s0", RUN_1, sellers=[1])
    (folder, before), = store.current()["pending"].items()
    assert len(before) > 10
    read = []
    documents = orders_stream._documents
    monkeypatch.setattr(
        orders_stream, "_documents", lambda *given: read.append(given[2]) or documents(*given)
    )
    run_orders_stream(store, str(landing), checkpoint, "s1", RUN_2, sellers=[7])
    (taken,) = read
    assert list(taken) == [folder] and len(taken[folder]) == 1
    assert set(store.current()["pending"][folder]) == set(before) - set(taken[folder])
    assert rows(store.read("orders"), "id") == [("1",), ("7",)]
    run_orders_stream(store, str(landing), checkpoint, "s2", RUN_3)
    assert store.read("orders").count() == 40
    # The folders of the version before stay for its readers.
    store.commit("x", {})
    store.commit("y", {})
    assert store.files.names("_pending") == []


def test_a_failed_run_leaves_what_is_pending(spark, store, tmp_path, monkeypatch):
    landing, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    land(spark, landing, [order("1"), order("2", seller=6)])
    run_orders_stream(store, str(landing), checkpoint, "s0", RUN_1, sellers=[5])
    before = store.current()["pending"]
    with monkeypatch.context() as patch:
        patch.setattr(order_plan, "flatten_payments", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_orders_stream(store, str(landing), checkpoint, "s1", RUN_2)
    assert store.current()["pending"] == before
    # Noted for the seller that was known and for the one that the run has met.
    assert {s: x[0] for s, x in state(store).items()} == {5: "failed", 6: "failed"}
    assert run_orders_stream(store, str(landing), checkpoint, "s1", RUN_2)
    assert rows(store.read("orders"), "id") == [("1",), ("2",)]
    assert {s: x[0] for s, x in state(store).items()} == {5: "completed", 6: "completed"}


def test_a_pause_of_a_run_over_all_sellers_is_noted(spark, store, tmp_path, monkeypatch):
    load_orders(spark, store, tmp_path, "r1", RUN_1, [order("1"), order("2", seller=6)])
    with monkeypatch.context() as patch:
        def interrupt(df):
            raise KeyboardInterrupt

        patch.setattr(order_plan, "flatten_payments", interrupt)
        with pytest.raises(KeyboardInterrupt):
            load_orders(spark, store, tmp_path, "r2", RUN_2, [order("3", seller=7)])
    assert state(store) == {5: ("paused", 0, "1"), 6: ("paused", 0, "2"), 7: ("paused", 0, None)}
    changed = [order("1", status="changed"), order("3", seller=7)]
    load_orders(spark, store, tmp_path, "r3", RUN_3, changed)
    assert rows(store.read("orders"), "id", "status") == [("1", "paid"), ("2", "paid"), ("3", "paid")]
    assert state(store) == {5: ("completed", 0, "1"), 6: ("completed", 0, "2"), 7: ("completed", 1, "3")}


def test_unreadable_orders_are_quarantined_whoever_is_asked_for(spark, store, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_text(json.dumps(order("1")) + "\n" + BROKEN + "\n")
    raw = with_arrival(read_landing(spark, str(tmp_path / "in"), schemas.RAW_ORDER))
    run_orders(store, raw, "r", RUN_1, ARRIVAL, sellers=[5])
    assert rows(store.read("orders"), "id") == [("1",)]
    assert rows(store.read("quarantine"), "reason", "raw_json") == [("unreadable document", BROKEN)]


# --- any order of deliveries ---------------------------------------------------


@pytest.mark.parametrize("sequence", list(itertools.permutations(range(3))))
def test_deliveries_in_any_order(spark, store, tmp_path, sequence):
    deliveries = (
        [order("1", order_items=[line(), line()]), order("2"), order("3", seller=6)],
        [order("1", status="second"), order("2", status=None), order("4"), order("4", status="last")],
        [order("1", status="third", order_items=None, payments=[payment("n")]), order("3", status="third", seller=6)],
    )
    for n in sequence:
        numbered = [{**d, "ord": 100 * n + k} for k, d in enumerate(deliveries[n])]
        raw = land(spark, tmp_path / f"in{n}", numbered, f"ord BIGINT, {schemas.RAW_ORDER}")
        run_orders(store, raw, f"r{n}", RUN_1, "ord", across_runs=True)
    assert rows(store.read("orders"), "id", "status") == [
        ("1", "third"), ("2", "paid"), ("3", "third"), ("4", "last")
    ]
    assert rows(store.read("order_items"), "order_id") == [("2",), ("3",), ("4",)]
    assert rows(store.read("payments"), "id") == [("n",), ("p-2",), ("p-3",), ("p-4",)]
    assert rows(store.read("quarantine"), "record_id") == [("2",)]
    assert rows(store.read("order_arrivals"), "order_id", "arrived.row") == [
        ("1", 200), ("2", 1), ("3", 201), ("4", 103)
    ]


def test_of_runs_with_numbers_of_their_own_the_later_one_wins(spark, store, tmp_path):
    load_orders(spark, store, tmp_path, "r2", RUN_2, [order("1", status="b"), order("2", status="b")])
    load_orders(spark, store, tmp_path, "r1", RUN_1, [order("0"), order("0"), order("1", status="a")])
    assert rows(store.read("orders"), "id", "status") == [("0", "paid"), ("1", "b"), ("2", "b")]
    load_orders(spark, store, tmp_path, "r3", RUN_2, [order("1", status="c")])
    assert rows(store.read("orders"), "id", "status") == [("0", "paid"), ("1", "c"), ("2", "b")]


def test_late_files_lose(spark, store, tmp_path):
    landing, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    land(spark, landing, [order("1", status="new")], name="new")
    os.utime(landing / "new.json", (2_000_000_000, 2_000_000_000))
    run_orders_stream(store, str(landing), checkpoint, "s1", RUN_1)
    land(spark, landing, [order("1", status="old"), order("2")], name="old")
    os.utime(landing / "old.json", (1_000_000_000, 1_000_000_000))
    run_orders_stream(store, str(landing), checkpoint, "s2", RUN_2)
    assert rows(store.read("orders"), "id", "status") == [("1", "new"), ("2", "paid")]


# --- parts ----------------------------------------------------------------------


def test_a_run_writes_the_parts_of_its_keys_only(spark, store, tmp_path):
    first = [order(str(n), seller=n, payments=[payment(f"p{n}")]) for n in range(60)]
    load_orders(spark, store, tmp_path, "r1", RUN_1, first)
    before = store.current()["tables"]
    part = store.parts_of("orders", spark.createDataFrame([("7",)], "id STRING"))
    load_orders(spark, store, tmp_path, "r2", RUN_2, [order("7", seller=7, status="changed")])
    after = store.current()["tables"]
    for name in ("orders", "order_items", "payments", "order_arrivals"):
        changed = {int(p) for p in after[name] if after[name][p] != before[name].get(p)}
        assert changed == set(part), name
    assert len(after["orders"]) > 20
    assert store.read("orders").count() == 60 and rows(store.read("orders", parts=part), "id", "status")
    assert rows(store.read("orders").filter("status <> 'paid'"), "id") == [("7",)]
    assert rows(store.read("order_days")) == rows(rollup.order_days(store.read("orders")))


def test_payment_ids_are_looked_up_in_their_parts_only(spark, store, tmp_path, monkeypatch):
    load_orders(spark, store, tmp_path, "r1", RUN_1, [order(str(n)) for n in range(60)])
    read, given = store.read, []
    monkeypatch.setattr(store, "read", lambda name, *a, **k: given.append((name, k.get("parts"))) or read(name, *a, **k))
    load_orders(spark, store, tmp_path, "r2", RUN_2, [order("x", payments=[payment("p-7")]), order("y")])
    assert {name for name, parts in given if parts is None} <= {"runs", "etl_state"}
    assert all(len(parts) <= 3 for name, parts in given if name in ("payments", "payment_owners"))
    assert rows(store.read("quarantine"), "record_id") == [("x",)]


def test_a_run_of_listings_writes_the_parts_of_its_keys_only(spark, store, tmp_path):
    load_items(spark, store, tmp_path, "r1", RUN_1, [listing(f"a{n}") for n in range(60)])
    before = store.current()["tables"]["items"]
    load_items(spark, store, tmp_path, "r2", RUN_2, [listing("a7", price=8)])
    after = store.current()["tables"]["items"]
    assert sum(after[p] != before[p] for p in before) == 1 and len(before) > 20
    assert store.read("items").count() == 60
    assert rows(store.read("items").filter("current_price > 0"), "item_id") == [("a7",)]


def test_the_number_of_parts_stays(spark, tmp_path):
    root = str(tmp_path / "t")
    load_orders(spark, TableStore(spark, root, parts=3), tmp_path, "r1", RUN_1, [order(str(n)) for n in range(20)])
    store = TableStore(spark, root, parts=50)
    load_orders(spark, store, tmp_path, "r2", RUN_2, [order("7", status="changed"), order("21")])
    assert set(store.current()["tables"]["orders"]) == {"0", "1", "2"}
    assert store.read("orders").count() == 21


# --- counts that are kept up to date --------------------------------------------


def test_sellers_per_category_follow_the_listings(spark, store, tmp_path):
    rng = random.Random(6)
    for run in range(4):
        documents = [
            listing(f"a{rng.randrange(12)}", seller_id=rng.choice([0, 1, 2, None]), category_id=rng.choice("XY"))
            for _ in range(8)
        ]
        load_items(spark, store, tmp_path, f"r{run}", RUN_1, documents)
        counts, items = store.read("category_sellers"), store.read("items")
        assert rows(counts) == rows(rollup.category_sellers(items))
        expected = items.filter("seller_id <> 0").groupBy("category_id").agg({"seller_id": "count"})
        assert {r[0] for r in rows(rollup.sellers_per_category(counts))} == {r[0] for r in rows(expected)}


def test_counts_per_day_equal_those_of_all_orders(spark, store, tmp_path):
    rng = random.Random(5)
    for run in range(4):
        batch = [
            order(
                str(rng.randrange(12)), seller=rng.choice([5, 6]), status=rng.choice(["paid", "new"]),
                date_created=f"2024-01-0{rng.randint(1, 3)}T{rng.randrange(24):02}:00:00Z", payments=None,
            )
            for _ in range(9)
        ]
        load_orders(spark, store, tmp_path, f"r{run}", RUN_1, batch)
        orders = store.read("orders")
        assert rows(store.read("order_days")) == rows(rollup.order_days(orders))
        given = store.read("etl_state")
        maintained = reports.stats_of_days(store.read("order_days"), given)
        assert rows(reports.stats_json(maintained)) == rows(
            reports.stats_json(reports.seller_stats(orders, given))
        )
        assert rows(rollup.count_by_status(store.read("order_days"))) == rows(reports.orders_by_status(orders))
    assert "orders/v" not in plan(maintained)


def test_arrival_order_follows_file_time_then_place(spark, tmp_path):
    land(spark, tmp_path / "in", [order("1"), order("2")], name="z")
    land(spark, tmp_path / "in", [order("3"), order("4")], name="a")
    os.utime(tmp_path / "in" / "z.json", (1, 1))
    raw = with_arrival(read_landing(spark, str(tmp_path / "in"), schemas.RAW_ORDER))
    assert [r.id for r in raw.orderBy(ARRIVAL).collect()] == ["1", "2", "3", "4"]
    assert orders_in_range(raw, "2025-01-01").isEmpty()


def test_documents_to_load_and_to_reject_are_parted_in_one_join(spark, store, tmp_path, monkeypatch):
    """The documents meet the dropped rows once; those that are rejected then are only filtered."""
    from tradewind.plans.staging import Stage

    put, staged = Stage.put, {}
    monkeypatch.setattr(Stage, "put", lambda self, name, df: staged.setdefault(name, plan(df)) and put(self, name, df))
    documents = [order(1, payments=[payment("p")]), order(2, payments=[payment("p")]), order(3), order(3), order(4, status=None)]
    raw = ordered(spark, tmp_path, documents, schemas.RAW_ORDER, "r")
    assert run_orders(store, raw, "r", RUN_1, "ord")
    assert "Join" in staged["rest"] and "Join" not in staged["rejected"]
    assert rows(store.read("orders"), "id") == [("3",)]
    assert rows(store.read("quarantine"), "record_id", "reason") == [
        ("1", "payment id is not unique"), ("2", "payment id is not unique"), ("4", "no status")
    ]
