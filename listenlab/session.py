"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder read from the session's own configuration."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "listenlab") -> SparkSession:
    """Local session used by tests and the bench. On a cluster, build the
    session with the cluster's own settings instead and pass it in."""
    builder = (
        SparkSession.builder.master(master or "local[8]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.driver.memory", "8g")
        # no per-call Python call-site capture while building plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(shuffle_partitions: int = 8000) -> dict[str, str]:
    """Suggested settings for a large cluster (pass to the session builder).

    AQE coalesces the generous shuffle partition count down to
    ``advisoryPartitionSizeInBytes`` per task and splits skewed join
    partitions; the session window is already split by (uid, time slice),
    which AQE would not do for a window. ``spark.checkpoint.dir`` must be set
    by the cluster to a shared folder."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when the session has none (local tests) a scratch folder is made
    and set; on a cluster the configured shared folder is always used."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="listenlab-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path
