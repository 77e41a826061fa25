import json

import pytest

from tradewind import schemas
from tradewind.__main__ import main

from conftest import rows
from documents import land, listing, order


@pytest.fixture
def folders(spark, tmp_path):
    land(spark, tmp_path / "items", [listing("a", category_id="C"), listing("b", seller_id=6)],
         schemas.RAW_ITEM)
    land(spark, tmp_path / "users", [{"id": 5, "nickname": "shop"}], schemas.RAW_USER)
    land(spark, tmp_path / "orders", [
        order("1"), order("2", date_created="2024-03-01T00:00:00Z"), order("3", seller=6),
        order("4", date_created="2024-02-01T00:00:00Z", status="new"),
    ])
    return {name: str(tmp_path / name) for name in ("items", "users", "orders", "root", "cp", "out")}


def test_items(folders, capsys):
    base = ["items", "--root", folders["root"], "--landing", folders["items"]]
    assert main(["init", "--root", folders["root"]]) == 0
    assert main(base) == 0
    assert json.loads(capsys.readouterr().out) == {"successful": 2, "total": 2}
    assert main([*base, "--seller", "5", "--seller", "9", "--run-id", "x"]) == 1
    assert json.loads(capsys.readouterr().out) == {"successful": 1, "total": 2}


def test_extract(spark, folders, tmp_path):
    land(spark, tmp_path / "d", [{"item_id": "a", "plain_text": "é"}], schemas.RAW_DESCRIPTION)
    base = ["extract", "--landing", folders["items"], "--out", folders["out"]]
    assert main([*base, "--descriptions", str(tmp_path / "d")]) == 0
    got = spark.read.json(folders["out"])
    assert rows(got, "id", "description") == [("a", "é"), ("b", "N/A")]
    assert "total_reviews" not in got.columns and "_arrival" not in got.columns


@pytest.mark.parametrize("stream", [False, True])
def test_orders_and_stats(folders, capsys, stream):
    base = ["orders", "--root", folders["root"], "--landing", folders["orders"], "--seller", "5"]
    assert main(base + (["--checkpoint", folders["cp"]] if stream else [])) == 0
    assert main(["stats", "--root", folders["root"], "--seller", "5"]) == 0
    stats = json.loads(capsys.readouterr().out)
    assert stats["order_counts"] == {"new": 1, "paid": 2}
    assert stats["etl_state"]["status"] == "completed"
    assert stats["date_range"]["latest"] == "2024-03-01T00:00:00"
    assert main(["stats", "--root", folders["root"], "--seller", "77"]) == 0
    assert json.loads(capsys.readouterr().out) == {"order_counts": {}}


def test_last_orders(folders, capsys):
    assert main(["last-orders", "--landing", folders["orders"], "--seller", "5"]) == 0
    found = json.loads(capsys.readouterr().out)["orders"]
    assert [o["id"] for o in found] == ["2", "4"] and found[0]["payments"][0]["id"] == "p-2"


def test_sellers(spark, folders, capsys):
    base = ["sellers", "--landing", folders["items"], "--users", folders["users"], "--category", "C"]
    assert main(base) == 0
    assert capsys.readouterr().out == "5\tshop\n"
    assert main([*base, "--out", folders["out"]]) == 0
    assert spark.read.csv(folders["out"], header=True).collect() == [("5", "shop")]
