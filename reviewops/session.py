"""Spark session helpers.

The library never builds its own session inside an operator: every operator
takes DataFrames and returns a DataFrame.  ``get_session`` is for scripts and
tests; on a cluster the caller's session (and its ``spark.checkpoint.dir``) is
used as-is.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants: AQE (runtime coalescing, skew-join splitting,
# broadcast conversion from measured sizes), UTC, Arrow for pandas exchange.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remote model calls must not be duplicated by speculative tasks.
    "spark.speculation": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "reviewops") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("REVIEWOPS_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is read unchanged.  Only
    when it is unset (local tests) a scratch folder is created and set.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir() if hasattr(
            spark.sparkContext, "getCheckpointDir") else None
    if not current:
        # A machine-local folder is only valid when driver and executors
        # share the machine; a cluster must name a shared folder.
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: set it to a folder on shared "
                             "storage that every executor can reach")
        current = tempfile.mkdtemp(prefix="reviewops-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    try:
        # Spark makes a new subfolder at every call, so it is told once
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
    except Exception:  # not allowed in connect mode
        pass
    return current


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local tmp)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def ensure_parallelism(df, *keys: str):
    """Hash-partition ``df`` on ``keys`` when it has fewer partitions than the
    session's default parallelism (e.g. a small single-row-group file read as
    one task before CPU-heavy row-local work such as the Python HTML parser).
    Any input with at least as many splits as the cluster has cores -- every
    large input -- is left alone; below that, one shuffle buys parallel
    parsing, which costs far more per byte than the shuffle.  The partitioning
    is on the join key, so a following shuffle join on that key reuses it."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:  # no RDD access (e.g. a Connect session): leave as is
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)
