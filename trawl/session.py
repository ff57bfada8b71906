"""Session construction and the shared scratch/checkpoint location.

On a cluster the checkpoint directory must be a shared file system that the
cluster names in ``spark.checkpoint.dir``; we read it from the session and only
invent one (a local temp dir) when it is unset *and* Spark runs in local mode,
which is the test and bench situation.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int | None = None,
                  app: str = "trawl") -> SparkSession:
    """A session; shuffle partitions are set from the cores in local mode only (or
    when given), a cluster's own setting is kept."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions or master.startswith("local"):
        parts = shuffle_partitions or max(8, 2 * _cores_of(master))
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _cores_of(master: str) -> int:
    if master.startswith("local[") and master[6:-1].isdigit():
        return int(master[6:-1])
    return os.cpu_count() or 8


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring it from
    ``spark.checkpoint.dir`` if needed.  A private temp dir is only made in
    local mode (tests); on a cluster an unset directory is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running trawl jobs")
        conf = tempfile.mkdtemp(prefix="trawl-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name next to the checkpoints (shared storage on a
    cluster) for intermediate tables, streaming checkpoints and sinks."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/trawl-{name}-{uuid.uuid4().hex[:12]}"
