import pytest
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.operators.orders import rejected, with_reject_reason
from tradewind.sources.landing import read_landing
from tradewind.streaming.orders_stream import run_orders_stream

from conftest import plan, rows
from documents import land, line, order


def test_any_lookup_table_can_be_read(spark, tmp_path):
    schema = "id STRING, name STRING, total_items BIGINT"
    land(spark, tmp_path / "categories", [{"id": "C1", "name": "É"}, {"id": "C2", "total_items": 3}], schema)
    df = read_landing(spark, str(tmp_path / "categories"), schema)
    assert rows(df) == [("C1", "É", None, None), ("C2", None, 3, None)]
    assert rows(read_landing(spark, str(tmp_path / "categories"), schema, where=F.col("id") == "C2")) == [
        ("C2", None, 3, None)
    ]


def test_unreadable_documents_keep_their_text(spark, tmp_path):
    lines = ['{"id": "1", "status": "paid"}', '{"id": "2", "stat', '{"id": "3", "seller": {"id": "x"}}']
    (tmp_path / "a.json").write_text("\n".join(lines))
    df = read_landing(spark, str(tmp_path), schemas.RAW_ORDER).cache()
    got = dict(rows(df, "_corrupt", "id"))
    assert set(got) == {None, lines[1], lines[2]} and got[None] == "1"
    checked = with_reject_reason(df)
    assert rows(rejected(checked).filter("reason = 'unreadable document'"), "raw_json") == [
        (lines[1],), (lines[2],)
    ]


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError, match="json or parquet"):
        read_landing(spark, "x", "id STRING", "csv")


def test_parquet_scan_reads_only_what_is_needed(spark, tmp_path):
    path = str(tmp_path / "orders")
    land(spark, tmp_path / "json", [order("1"), order("2")]).write.parquet(path)
    df = read_landing(spark, path, schemas.RAW_ORDER, "parquet", F.col("status") == "paid")
    text = plan(df.select("id", "payments.id"))
    assert "ReadSchema: struct<id:string,status:string,payments:array<struct<id:string>>>" in text
    assert "EqualTo(status,paid)" in text


def test_parquet_files_can_be_followed(spark, store, tmp_path):
    path = str(tmp_path / "orders")
    documents = [order("1", order_items=[line(), line()]), order("2", date_created="x")]
    land(spark, tmp_path / "json", documents).write.parquet(path)
    run_orders_stream(store, path, str(tmp_path / "cp"), "s", "2024-06-01", fmt="parquet")
    assert rows(store.read("order_items"), "order_id") == [("1",), ("1",)]
    assert rows(store.read("quarantine"), "record_id", "reason") == [("2", "no valid date_created")]


def test_landings_of_texts_are_packed(spark, tmp_path):
    """As plain text the order documents took some 25 times the tables; packed files stay small, and are several."""
    import os

    from tradewind.sources import testdata as td

    texts, folder = td.order_texts(spark, "/root/testdata/sf0.001"), str(tmp_path / "texts")
    td.land(texts, folder, "text", file_rows=100)
    files = [n for n in os.listdir(folder) if n.startswith("part-")]
    assert len(files) >= 8 and all(n.endswith(".gz") for n in files)
    expected = sorted(r.value for r in texts.collect())
    assert sum(os.path.getsize(f"{folder}/{n}") for n in files) < sum(map(len, expected)) / 5
    assert sorted(r.value for r in spark.read.text(folder).collect()) == expected
