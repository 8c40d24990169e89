"""Session helpers: a tuned local/cluster session and the lineage-cut policy."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults that matter at any scale: AQE re-plans joins and coalesces
# partitions from real shuffle sizes, and splits skewed join partitions
# (a hot key is broken into several tasks instead of one straggler).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # old rank vectors etc. are deleted from the checkpoint folder once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs.

    On a cluster the caller's session is used as is; this builder is only a
    convenience for ``local[N]`` runs.
    """
    master = master or os.environ.get("QUARRY_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = os.environ.get("QUARRY_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the reliable checkpoint folder, setting one only when unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is
    read from the session. A machine-local temporary folder is only chosen
    in local mode (tests, bench); on a cluster an unset folder is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not re.match(r"local(\[|$)", sc.master):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder for checkpoints")
    local_dir = tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp")
    atexit.register(shutil.rmtree, local_dir, ignore_errors=True)
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir()


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that end in it go at once, not when the driver next collects garbage."""
    conf = spark.conf
    before = conf.get(_CLEAN, None)
    conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        conf.unset(_CLEAN) if before is None else conf.set(_CLEAN, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` to the reliable checkpoint folder and cut its plan.

    Reliable checkpoints survive executor loss (unlike local checkpoints,
    which live on executor disks). What they were made from is not read
    again: its shuffle files go with the plan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_go(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a query that begins here
