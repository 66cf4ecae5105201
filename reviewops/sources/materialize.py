"""Write-once materialization of derived inputs.

In production the review table, the landed feed pages and the answer ledger
are stored data that every job reads.  The test fixtures derive them from the
driver tables; ``materialized`` writes such a derivation once as a table under
the shared ``spark.checkpoint.dir`` (keyed by a fingerprint of the input
files: paths, sizes, modification times) and hands out a fresh read of it.
Writing it also cuts the lineage of the derivation.  A half-written table is
never used: only a directory with Spark's ``_SUCCESS`` marker counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch_path

_PATHS: dict[tuple, str] = {}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def fingerprint(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> str:
    h = hashlib.sha256(sf_dir.encode())
    for t in tables:
        fs, p, _ = _fs(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        st = fs.getFileStatus(p)
        h.update(f"{t}:{st.getLen()}:{st.getModificationTime()}".encode())
    return h.hexdigest()[:16]


def materialize_path(spark: SparkSession, sf_dir: str, name: str, tables: tuple[str, ...],
                     build: Callable[[SparkSession, str], DataFrame], fmt: str = "parquet") -> str:
    """Path of the written derivation (written now if no complete copy exists)."""
    key = (spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", ""),
           sf_dir, name)
    path = _PATHS.get(key)
    if path is None:
        path = scratch_path(spark, "derived", f"{name}-{fingerprint(spark, sf_dir, tables)}")
        fs, p, jvm = _fs(spark, path)
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")):
            out = build(spark, sf_dir).write.mode("overwrite").format(fmt)
            (out.option("compression", "zstd") if fmt == "parquet" else out).save(path)
        _PATHS[key] = path
    return path


def materialized(spark: SparkSession, sf_dir: str, name: str, tables: tuple[str, ...],
                 build: Callable[[SparkSession, str], DataFrame], schema: T.StructType,
                 fmt: str = "parquet") -> DataFrame:
    path = materialize_path(spark, sf_dir, name, tables, build, fmt)
    return spark.read.schema(schema).format(fmt).load(path)
