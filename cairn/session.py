"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cairn", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    UTC session time zone (oracle comparisons), AQE on, UI off.  Only sets
    ``spark.checkpoint.dir`` when nothing else did (local runs and tests).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoint files go when the last frame that reads them is collected
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession, sub: str | None = None) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only when it is unset and the master is local
    (tests, laptops) is a private folder created and installed.  ``sub``
    returns a fresh unique sub-folder path (not created) under it.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            base = tempfile.mkdtemp(prefix="cairn-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    if sub is None:
        return base
    return os.path.join(base, f"{sub}-{uuid.uuid4().hex[:12]}")
