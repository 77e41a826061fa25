"""Open entries of the quarantine and their replay."""

import itertools
import json

import pytest

from tradewind import schemas
from tradewind.__main__ import main
from tradewind.plans.orders_run import run_orders
from tradewind.plans.replay import CORRECTIONS, replay_orders
from tradewind.plans.tables import TableStore
from tradewind.sources.landing import ARRIVAL, read_landing, with_arrival
from tradewind.streaming.orders_stream import run_orders_stream

from conftest import rows
from documents import land, order, ordered

RUN_1, RUN_2, RUN_3 = "2024-06-01 12:00:00", "2024-06-02 12:00:00", "2024-06-03 12:00:00"


def load(spark, store, tmp_path, run, as_of, documents, **kw):
    raw = ordered(spark, tmp_path, documents, name=run)
    return run_orders(store, raw, run, as_of, "ord", **kw)


def still_open(store):
    return rows(store.read("quarantine_open"), "entry", "reason", "n_attempts", "opened_by")


def closed(store):
    return rows(store.read("quarantine_closed"))


def test_a_later_copy_closes_the_entry(spark, store, tmp_path):
    load(spark, store, tmp_path, "r1", RUN_1, [order("1", status=None), order("2"), order("3", status=None)])
    assert still_open(store) == [("1", "no status", 1, "r1"), ("3", "no status", 1, "r1")]
    load(spark, store, tmp_path, "r2", RUN_2, [order("1", currency_id=None), order("3")])
    assert still_open(store) == [("1", "no currency", 2, "r1")]
    assert closed(store) == [("3", 1, "r1", "r2")]
    load(spark, store, tmp_path, "r3", RUN_3, [order("1")])
    assert still_open(store) == [] and closed(store) == [("1", 2, "r1", "r3"), ("3", 1, "r1", "r2")]
    # What was rejected stays in the quarantine itself.
    assert rows(store.read("quarantine"), "record_id") == [("1",), ("1",), ("3",)]


def test_within_a_run_the_last_copy_decides(spark, store, tmp_path):
    documents = [order("1", status=None), order("1"), order("2"), order("2", status=None),
                 order("3", status=None), order("3", currency_id=None)]
    load(spark, store, tmp_path, "r1", RUN_1, documents)
    assert still_open(store) == [("2", "no status", 1, "r1"), ("3", "no currency", 2, "r1")]
    assert closed(store) == [("1", 1, "r1", "r1")]
    assert rows(store.read("orders"), "id") == [("1",), ("2",)]


@pytest.mark.parametrize("turns", list(itertools.permutations(range(3))))
def test_deliveries_in_any_order_leave_the_same_entries(spark, store, tmp_path, turns):
    deliveries = [
        [order("1", status=None), order("2"), order("3"), order("4", status=None)],
        [order("1"), order("2", currency_id=None), order("4", status=None)],
        [order("3", status=None), order("4")],
    ]
    landed = [
        ordered(spark, tmp_path, d, name=f"d{n}").selectExpr(
            f"ord + {10 * n} AS at", *[f"`{c}`" for c in order_columns(spark)]
        )
        for n, d in enumerate(deliveries)
    ]
    for n in turns:
        run_orders(store, landed[n], f"r{n}", RUN_1, "at", across_runs=True)
    assert rows(store.read("quarantine_open"), "entry", "reason") == [
        ("2", "no currency"), ("3", "no status")
    ]
    assert rows(store.read("orders"), "id") == [("1",), ("2",), ("3",), ("4",)]


def order_columns(spark):
    return spark.createDataFrame([], schemas.RAW_ORDER).columns


def test_replay_of_corrected_and_uncorrected_orders(spark, store, tmp_path):
    documents = [order("1", status=None), order("2", status=None), order("3", status=None), order("4")]
    load(spark, store, tmp_path, "r1", RUN_1, documents)
    before = rows(store.read("etl_state"))
    given = [("1", json.dumps(order("1"))), ("2", None), ("9", json.dumps(order("9")))]
    corrections = spark.createDataFrame(given, CORRECTIONS)
    assert replay_orders(store, "again", RUN_2, corrections)
    assert not replay_orders(store, "again", RUN_2, corrections)
    assert rows(store.read("orders"), "id") == [("1",), ("4",)]
    assert rows(store.read("payments"), "id") == [("p-1",), ("p-4",)]
    assert still_open(store) == [("2", "no status", 2, "r1"), ("3", "no status", 1, "r1")]
    assert closed(store) == [("1", 1, "r1", "again")]
    assert rows(store.read("etl_state")) == before
    # All that are open, as they came.
    assert replay_orders(store, "all", RUN_3)
    assert still_open(store) == [("2", "no status", 3, "r1"), ("3", "no status", 2, "r1")]


def test_a_replay_does_not_undo_what_came_later(spark, store, tmp_path):
    load(spark, store, tmp_path, "r1", RUN_1, [order("1", status=None)])
    load(spark, store, tmp_path, "r2", RUN_2, [order("1", status="new")])
    assert still_open(store) == []
    fixed = spark.createDataFrame([("1", json.dumps(order("1", status="old")))], CORRECTIONS)
    assert not replay_orders(store, "again", RUN_3, fixed)
    assert rows(store.read("orders"), "id", "status") == [("1", "new")]


def test_an_unreadable_document_is_closed_by_its_correction(spark, store, tmp_path):
    land(spark, tmp_path / "in", [order("1")])
    (tmp_path / "in" / "x.json").write_text('{"id": "2", "sel\n{"id": "3", "sel\n')
    run_orders_stream(store, str(tmp_path / "in"), str(tmp_path / "cp"), "s", RUN_1)
    entries = {r.raw_json: r.entry for r in store.read("quarantine_open").collect()}
    assert len(entries) == 2 and all(e.startswith("sha256:") for e in entries.values())
    two, three = (entries[f'{{"id": "{n}", "sel'] for n in (2, 3))
    # One is still wrong in another way; both name the same entry from then on.
    given = [(two, json.dumps(order("2"))), (three, json.dumps(order("3", status=None)))]
    assert replay_orders(store, "r", RUN_2, spark.createDataFrame(given, CORRECTIONS))
    assert rows(store.read("orders"), "id") == [("1",), ("2",)]
    assert still_open(store) == [(three, "no status", 2, "s")] and closed(store) == [(two, 1, "s", "r")]
    given = [(three, json.dumps(order("3")))]
    assert replay_orders(store, "r2", RUN_3, spark.createDataFrame(given, CORRECTIONS))
    assert still_open(store) == [] and rows(store.read("orders"), "id") == [("1",), ("2",), ("3",)]


def test_two_corrections_to_one_order(spark, store, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_text('{"a\n{"b\n')
    landed = with_arrival(read_landing(spark, str(tmp_path / "in"), schemas.RAW_ORDER))
    run_orders(store, landed, "r1", RUN_1, ARRIVAL)
    first, last = (r.entry for r in store.read("quarantine_open").orderBy("arrived").collect())
    given = [(first, json.dumps(order("1", status="a"))), (last, json.dumps(order("1", status="b")))]
    assert replay_orders(store, "again", RUN_2, spark.createDataFrame(given, CORRECTIONS))
    assert rows(store.read("orders"), "id", "status") == [("1", "b")]
    assert still_open(store) == [] and len(closed(store)) == 2


def test_an_empty_store_has_nothing_to_replay(spark, store, tmp_path):
    assert not replay_orders(store, "again", RUN_1)
    load(spark, store, tmp_path, "r1", RUN_1, [order("1")])
    assert not replay_orders(store, "again", RUN_1)
    assert still_open(store) == [] and closed(store) == []


def test_replay_command(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tradewind.__main__.build_session", lambda *a, **kw: spark)
    store = TableStore(spark, str(tmp_path / "tables"))
    load(spark, store, tmp_path, "r1", RUN_1, [order("1", status=None)])
    path = tmp_path / "corrections.json"
    path.write_text(json.dumps({"entry": "1", "document": json.dumps(order("1"))}) + "\n")
    assert main(["replay", "--root", store.root, "--corrections", str(path)]) == 0
    store.refresh()
    assert rows(store.read("orders"), "id") == [("1",)] and still_open(store) == []
