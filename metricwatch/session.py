"""Spark session for tests, the bench and local runs.

Library functions never create or reconfigure a session; they take DataFrames. This helper is
for entry points only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "metricwatch") -> SparkSession:
    """Local session with AQE on, UI off, UTC session time and a checkpoint dir if none is set."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # small inputs that fan out (forest: rows x trees) still get one task per core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only a local session (driver and executors in one process) may do without that setting: it
    gets a fresh scratch folder. A cluster without it is an error, since a folder of the driver's
    machine is not the executors'. Spark Connect sessions have no handle and use the setting alone.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no JVM context on the client
        if configured:
            return configured
        raise
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return configured or current.get()
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="metricwatch-ckpt-")
    sc.setCheckpointDir(configured)
    return configured
