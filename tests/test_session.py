from types import SimpleNamespace

import pytest

from tradewind.session import shared_folder, shuffle_partitions


class Context:
    folder, master = None, "local[2]"

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(setting=None, folder=None, master="local[2]"):
    context = Context()
    context.folder, context.master = folder, master
    return SimpleNamespace(sparkContext=context, conf={"spark.checkpoint.dir": setting})


def test_the_clusters_folder_is_used():
    assert shared_folder(session("s3://shared/cp/")) == "s3://shared/cp"
    assert shared_folder(session(None, "hdfs:/cp")) == "hdfs:/cp"


def test_a_local_session_gets_one_folder():
    spark = session()
    assert shared_folder(spark) == shared_folder(spark) and "tradewind-" in shared_folder(spark)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(master=master))


def test_shuffle_partitions():
    assert shuffle_partitions(0) == 8
    assert shuffle_partitions(1 << 40) == 8192
    assert shuffle_partitions(100 << 40) == 100_000


def test_staged_texts_are_not_taken_for_small(spark, tmp_path):
    """A file of a few hundred KB with documents of 40 MB: no hash table of them is made on the driver."""
    from pyspark.sql import functions as F

    from conftest import plan
    from tradewind.plans.staging import FACTOR, staging

    before = spark.conf.get(FACTOR)
    text = F.concat(F.repeat(F.lit('{"status":"approved"},'), 90), F.col("id").cast("string"))
    rows = spark.range(20000).select("id", text.alias("text"))
    rows.write.parquet(str(tmp_path / "stored"))
    with staging(spark) as stage:
        staged = stage.put("texts", rows)
        joined = spark.read.parquet(str(tmp_path / "stored")).select("id").join(staged, "id")
        few = stage.put("few", spark.range(3).toDF("id"))
        assert "BroadcastHashJoin" not in plan(joined)
        assert joined.count() == 20000
        assert "BroadcastHashJoin" in plan(staged.join(few, "id"))
    assert spark.conf.get(FACTOR) == before
