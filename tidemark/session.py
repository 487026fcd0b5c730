"""Session helpers for tests, the bench and local runs.

Library code never changes session configuration; these helpers are only used
where this repository owns the session (tests, ``bench.py``).
"""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import time

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces partitions at
# runtime, skew-join splitting handles hot keys on sort-merge joins.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Shuffle files of finished jobs are given back at most once in so many seconds (it takes about 0.2 s).
FREE_EVERY_S = 5.0
_freed_at = 0.0


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files that no plan refers to any more. Called behind a finished stage table.

    Spark does so once the driver's garbage collection has found their plans unused. A driver that only starts jobs may
    not collect for a long time, and the files of all jobs until then stay on the executors' disks.
    """
    global _freed_at
    if time.monotonic() - _freed_at >= FREE_EVERY_S:
        spark.range(0, 1, 1, 1).collect()   # the scheduler holds on to its last job: let that be a small one
        gc.collect()    # Python's references to finished plans
        spark._jvm.System.gc()
        _freed_at = time.monotonic()


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
        # one host: waiting for a "more local" slot buys nothing
        .config("spark.locality.wait", "0s")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A cluster without the setting is an error: a folder of the driver's machine is not seen by the executors. Only a
    session that runs in one process (local mode, as in tests) gets a private folder, removed when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(path)
    return path
