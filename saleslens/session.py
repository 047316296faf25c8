"""Session construction and the shared work folder.

Cluster rule: intermediate tables go to the folder the cluster names in
``spark.checkpoint.dir``. We only choose our own folder when that setting is
absent (tests and local runs).
"""

from __future__ import annotations

import logging
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins from measured shuffle
# sizes (broadcast only when the runtime size is under the threshold), splits
# skewed sort-merge partitions, and coalesces small shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    # A hot join key is split even when that costs one more shuffle before the aggregate above.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # Static broadcast off: size estimates from compressed Parquet footers are unreliable
    # (a 600k-row line table estimated at ~6 MB is ~130 MB as a hash relation). Only AQE's
    # measured shuffle sizes, or explicit hints on bounded tables, lead to a broadcast.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # A sort-merge join whose every post-shuffle partition is small runs as a shuffled
    # hash join (no sort); the bound is per partition, so it holds at any scale.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "saleslens") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.appName(app)
    if master is not None:
        b = b.master(master)
    else:
        b = b.master(f"local[{cpus}]")
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.driver.host", "127.0.0.1")
          .config("spark.driver.bindAddress", "127.0.0.1")
          .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
          .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus) * 2)))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session made elsewhere (the driver's)."""
    for k, v in SCALE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception as e:  # static or locked settings stay as they are
            logging.getLogger(__name__).warning("%s stays as it is: %s", k, type(e).__name__)
    work_root(spark)
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="saleslens-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, never-reused folder under the shared work root."""
    root = spark.conf.get("spark.checkpoint.dir", None) or work_root(spark)
    return f"{root.rstrip('/')}/saleslens/{label}-{uuid.uuid4().hex[:12]}"
