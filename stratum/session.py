"""Session settings the jobs are written for, and where they may put working files."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where that costs one more shuffle of what is left after grouping.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Files written through the rebalance hint come out near this size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Lets a two-way partitioned write keep both files open instead of sorting every task.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def build_session(app: str = "stratum", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """A fresh folder for intermediate tables, below the shared checkpoint folder.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        import uuid

        return f"{shared.rstrip('/')}/stratum-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="stratum-")
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
