"""Spark session helpers.

Library code never builds its own session: every operator takes a
DataFrame (or a session handed in by the caller).  These helpers are for
tests, the bench script and command-line jobs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  AQE is what turns the
# size-agnostic joins below into broadcast joins when (and only when) the
# measured runtime size is under the threshold, and what splits skewed
# shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "riskloom",
                  shuffle_partitions: int = 8, driver_memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None under Spark Connect (no driver-side context)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is only read here.
    Where it is unset in local mode (tests) a private scratch folder is
    created and registered so that ``DataFrame.checkpoint()`` and model saves
    work; anywhere else an unset folder is an error.
    """
    sc = _context(spark)
    path = spark.conf.get("spark.checkpoint.dir", None)
    if sc is not None and not path:
        path = sc.getCheckpointDir()
    if not path:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: checkpoints, model saves and "
                               "stream state must survive the loss of an executor")
        path = tempfile.mkdtemp(prefix="riskloom-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - a core conf may be read-only at runtime
            pass
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return (sc.getCheckpointDir() if sc is not None else None) or path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir)."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)
