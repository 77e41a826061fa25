import pytest
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.plans.staging import staging
from tradewind.plans.tables import TABLES, TableStore

from conftest import plan, rows


def orders(spark, *pairs):
    data = [(id, status) for id, status in pairs]
    return spark.createDataFrame(data, "id STRING, status STRING").select(
        *[F.col(c) if c in ("id", "status") else F.lit(None).alias(c)
          for c in [f.strip().split()[0] for f in schemas.ORDERS.replace("10,2", "10").split(",")]]
    )


def lines(spark, *pairs):
    df = spark.createDataFrame(list(pairs), "order_id STRING, item_id STRING")
    names = [f.strip().split()[0] for f in schemas.ORDER_ITEMS.replace("10,2", "10").split(",")]
    return df.select(
        *[F.xxhash64("order_id", "item_id").alias("id") if c == "id"
          else F.col(c) if c in df.columns else F.lit(None).alias(c) for c in names]
    )


def test_new_tables_are_empty(spark, store):
    store.init_tables()
    store.init_tables()
    assert store.files.names("_versions") == ["000000000001.json"]
    for name in TABLES:
        assert store.read(name).isEmpty()
        assert len(store.read(name).columns) > 1


def test_a_run_is_applied_once_and_replaces_its_tables(spark, store):
    assert store.commit("r1", {"orders": orders(spark, ("1", "a"), ("2", "a"))})
    assert not store.commit("r1", {"orders": orders(spark, ("1", "zz"))})
    assert store.commit("r2", {"orders": orders(spark, ("2", "b"), ("3", "b"))})
    assert rows(store.read("orders"), "id", "status") == [("2", "b"), ("3", "b")]
    assert rows(store.read("runs"), "run_id") == [("r1",), ("r2",)]


def test_failed_commit_is_invisible(spark, store):
    store.commit("r1", {"orders": orders(spark, ("1", "a"))})
    broken = orders(spark, ("1", "b")).withColumn("status", F.raise_error(F.lit("lost")).cast("string"))
    quarantine = spark.sql("SELECT 'a' AS source, 'b' AS record_id, 'c' AS reason, 'd' AS raw_json")
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            store.commit("r2", {"quarantine": quarantine, "orders": broken})
    assert rows(store.read("orders"), "id", "status") == [("1", "a")]
    assert store.read("quarantine").isEmpty() and not store.has_run("r2")
    assert store.commit("r2", {"quarantine": quarantine, "orders": orders(spark, ("1", "b"))})
    assert rows(store.read("orders"), "id", "status") == [("1", "b")]
    assert store.read("quarantine").count() == 1


def test_of_two_writers_one_fails(spark, store):
    store.init_tables()
    other = TableStore(spark, store.root)
    other.current()
    store.commit("r1", {"orders": orders(spark, ("1", "a"))})
    with pytest.raises(RuntimeError, match="another run"):
        other.commit("r2", {"orders": orders(spark, ("2", "b"))})
    other.refresh()
    assert rows(other.read("orders"), "id") == [("1",)]
    assert other.commit("r2", {"orders": orders(spark, ("2", "b"))})


def test_a_half_written_version_is_passed_over(spark, store):
    store.commit("r1", {"orders": orders(spark, ("1", "a"))})
    versions = store.files.names("_versions")
    for text in ("", '{"tables"'):
        number = int(versions[-1].split(".")[0]) + 1
        with open(f"{store.root}/_versions/{number:012}.json", "w") as file:
            file.write(text)
        store.refresh()
        assert rows(store.read("orders"), "id") == [("1",)]
        versions = store.files.names("_versions")
    assert store.commit("r2", {"orders": orders(spark, ("2", "b"))})
    store.refresh()
    assert rows(store.read("orders"), "id") == [("2",)] and store.has_run("r1")
    for n in range(3):
        store.commit(f"s{n}", {})
    assert len(store.files.names("_versions")) == 2


def test_small_files_appear_whole_or_not_at_all(spark, store, monkeypatch):
    assert store.files.create("x/a.json", "one") and not store.files.create("x/a.json", "two")
    assert store.files.read("x/a.json") == "one"
    monkeypatch.setattr(store.files, "_rename", lambda *given: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.files.create("x/b.json", "three")
    assert [n for n in store.files.names("x") if n.endswith(".json")] == ["a.json"]


def test_another_store_sees_runs_after_a_refresh(spark, store):
    reader = TableStore(spark, store.root)
    assert reader.read("orders").isEmpty()
    store.commit("r1", {"orders": orders(spark, ("1", "a"))})
    assert reader.read("orders").isEmpty()
    reader.refresh()
    assert rows(reader.read("orders"), "id") == [("1",)]


def test_old_versions_are_removed(spark, store):
    for n in range(5):
        before = store.read("orders")
        store.commit(f"r{n}", {"orders": orders(spark, (str(n), "a"))})
        if n:
            # A reader that was at it still gets its version.
            assert rows(before, "id") == [(str(n - 1),)]
    assert len(store.files.names("orders")) == 2 and len(store.files.names("_versions")) == 2


def test_similar_run_ids_do_not_share_a_folder(spark, store):
    entry = "SELECT 'a' AS source, '{}' AS record_id, 'c' AS reason, 'd' AS raw_json"
    store.commit("a/b", {"quarantine": spark.sql(entry.format(1))})
    store.commit("a_b", {"quarantine": spark.sql(entry.format(2))})
    assert rows(store.read("quarantine"), "record_id") == [("1",), ("2",)]
    assert rows(store.read("quarantine", "a_b"), "record_id") == [("2",)]


def test_history_is_partitioned_by_day(spark, store):
    for run, day in (("r1", "2024-06-01"), ("r2", "2024-06-02")):
        df = spark.sql(
            f"SELECT '1' AS id, 'a' AS item_id, 1D AS price, 0D AS discount_percentage, "
            f"NULL AS competitor_rank, NULL AS price_position, "
            f"TIMESTAMP_NTZ'{day} 00:00:00' AS recorded_at, DATE'{day}' AS recorded_date"
        )
        store.commit(run, {"price_history": df})
    history = store.read("price_history")
    assert history.count() == 2
    one = history.filter("recorded_date = DATE'2024-06-02'")
    assert one.count() == 1 and "isnotnull(recorded_date" in plan(one).split("PartitionFilters")[1]
    assert store.read("price_history", "r1").count() == 1


def test_staged_tables_are_removed(spark):
    with staging(spark) as stage:
        df = stage.put("x", spark.range(5))
        assert df.count() == 5
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage.root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert not files.exists(path)
