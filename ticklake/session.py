"""Spark session helpers.

The library never creates a session behind the caller's back inside an
operator; jobs and tests call :func:`get_spark`.  Settings here are the ones
the operators rely on for correctness (UTC session zone) or that keep a
local run sensible (shuffle partitions ~ cores, AQE on).  On a cluster the
submitter's settings win: :func:`get_spark` only fills in what is unset.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators assume.  AQE is what turns size-checked joins into
# broadcasts at run time and splits skewed shuffle partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the indicator plans derive ~100 columns through stacked windows;
    # constraint propagation over them grows combinatorially (minutes of
    # optimizer time for a small join on top) and infers nothing useful
    "spark.sql.constraintPropagation.enabled": "false",
    # indicator window stages are CPU-bound (dozens of derived columns per
    # row): a shuffle that is small in bytes still carries much work, so let
    # AQE coalesce to 256 KB partitions rather than 1 MB.  Measured on the
    # one-minute grid (216k rows): 4 tasks / 13-15 s -> 8 tasks / 7-8 s.
    # Large shuffles are unaffected (their partitions are far above this).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
}


def get_spark(master: str | None = None, app: str = "ticklake", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {"spark.ui.enabled": "false", **(extra or {})}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # what the submitter or the caller has set stays
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for k, v in DEFAULTS.items():
        if k not in given:
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event times are UTC instants; every operator assumes a UTC session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting that holds inside the block; the caller's own value
    comes back after it."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage cuts.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (a
    shared file system), or whatever the job already set; without either it
    is an error, because executors would write to their own disks.  Only a
    local master (one process, one disk) gets a scratch folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect: the server's configuration applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d and sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="ticklake-ckpt-", dir=os.environ.get("TICKLAKE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
