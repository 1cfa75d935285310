"""Session construction and shared-storage helpers.

On a cluster the session is created by the platform; ``get_session`` only
fills in settings that are still unset.  Scratch data (written tables that
cut lineage, landed files, streaming checkpoints) always lives below the
shared folder named by ``spark.checkpoint.dir``; where that setting is missing
a local folder is created under a local master, and any other master is
refused.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Codec of the tables below the scratch folder.
TABLE_CODEC = "zstd"


def get_session(master: str | None = None, partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName("martkit")
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", "16g")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = builder.getOrCreate()
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        # One machine (tests): a local folder is shared by definition.
        d = tempfile.mkdtemp(prefix="martkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path below the shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return os.path.join(base, "martkit-scratch", f"{name}-{uuid.uuid4().hex}")


def run_concurrently(*steps):
    """Run independent steps (each submits its own Spark jobs) from driver
    threads, so small jobs share the executors instead of queueing; returns
    their results in order."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        futures = [pool.submit(step) for step in steps]
        return [f.result() for f in futures]
