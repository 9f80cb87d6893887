"""Spark session and checkpoint-directory helpers.

Every operator in the package takes an existing ``SparkSession`` (or a
DataFrame bound to one); nothing here hides Spark.  ``get_spark`` is only a
convenience for tests, the benchmark and the smoke entry point.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on: adaptive execution (runtime broadcast
# conversion behind a measured size, partition coalescing, skew-join
# splitting), UTC timestamps, Arrow batches for the few pandas UDFs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "lifetab", conf: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults."""
    master = master or os.environ.get("LIFETAB_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("LIFETAB_SHUFFLE_PARTITIONS", "8"))
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(parts)
    settings.setdefault("spark.driver.memory", os.environ.get("LIFETAB_DRIVER_MEMORY", "16g"))
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a directory.

    On a cluster the directory comes from ``spark.checkpoint.dir`` (a shared
    file system named by the deployment).  Only a local-mode session without
    that setting gets a scratch directory of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared directory before running iterative operators")
    path = tempfile.mkdtemp(prefix="lifetab-ckpt-")
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lifetab-{name}-{uuid.uuid4().hex}"
