"""Spark session defaults and the shared checkpoint folder.

On a cluster the session is handed to us already configured; these helpers
only fill in what is unset, and never replace a value the cluster names.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the jobs in this package. AQE re-plans joins and
# coalesces tiny shuffle partitions at runtime and splits skewed partitions;
# the jobs are written so that they do not depend on it for correctness.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Client-side call-site capture for every Column call; a debugging aid that
    # costs about half of the time spent building each query's plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "clickstats", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (the cluster brings its own)."""
    conf = {**DEFAULTS, **(extra or {})}
    if "spark.checkpoint.dir" not in conf:
        # A test session has no shared folder; give it a fresh scratch one.
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(
            prefix="clickstats-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g")
               .config("spark.sql.files.maxPartitionBytes", "4m"))  # small test files still give several tasks
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder (HDFS, object store) and
    is used as is. A local session without it gets a fresh scratch folder;
    a cluster session without it is an error, since a machine-local folder
    would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    scratch = tempfile.mkdtemp(prefix="clickstats-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def state_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder, for tables jobs write and re-read."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, *parts])
