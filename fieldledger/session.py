"""Session settings the jobs are written for, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE does three jobs here: it turns a shuffled join into a broadcast once the
# real size of a side is known, splits the partitions of hot keys, and merges
# small ones. Executor-level settings (memory, cores) stay with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "fieldledger", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written intermediate tables.

    Clusters name a shared folder in ``spark.checkpoint.dir``. A local master
    (tests, laptops) may fall back to a temporary folder; a cluster may not,
    because executors do not see each other's disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        return tempfile.mkdtemp(prefix=f"fieldledger-{purpose}-")
    return f"{base.rstrip('/')}/fieldledger/{purpose}-{uuid.uuid4().hex}"
