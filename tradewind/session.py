"""Session settings for the command line, tests and the benchmark.

Jobs submitted to a cluster may bring their own session; nothing below is
required for correct results.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot join key's partition; see operators.lookup for what it covers.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
}


def shuffle_partitions(input_bytes: int, target_bytes: int = 128 << 20, cores: int = 8) -> int:
    """Initial shuffle partitions for an input size; AQE merges what is too small."""
    return max(cores, min(100_000, -(-input_bytes // target_bytes)))


def build_session(
    app: str, master: str | None = None, partitions: int | None = None, memory: str | None = None
) -> SparkSession:
    """Session with the settings above; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see, as the cluster names it in spark.checkpoint.dir.

    Only a local session without one gets a temporary folder; on a cluster that would be
    one machine's, so there it is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tradewind-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")
