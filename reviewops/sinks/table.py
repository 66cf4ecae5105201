"""Review table storage and the other sinks.

Table layout: ``<root>/version=<n>/`` Parquet directories.  A version is
complete when Spark's commit protocol has written its ``_SUCCESS`` marker;
readers take the highest complete version.  Inserts append new files to the
current version (a job's files become visible together at commit); whole-row
replacements (update / upsert / replace) write the next version, so a table
is never overwritten while it is being read and a failed job leaves the
previous version current.  Writing a version also cuts the lineage of the
pipeline that produced it.  Optionally a version is written hash-clustered and
sorted by ``ID`` (``repartition(n, 'ID')`` + ``sortWithinPartitions('ID')``):
Parquet min/max statistics then let key lookups skip row groups.  Skipping the
shuffle of a later join would need ``bucketBy`` with a persistent catalog,
which this file-based layout does not assume.

Merge on read: instead of the next version, an upsert may be written as a *patch*
to the current one (``<root>/patches/version=<n>/patch=<k>/``), which costs what
its rows cost.  A reader takes the newest patch row of an ID and the version's rows
of all other IDs; a patch without its marker is not there.  ``compact`` writes
version and patches as the next version, as a job of its own.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ts_literal
from ..operators.audit import duplicate_ids
from ..operators.merge import guard_unique_keys, merge_upsert
from ..schema import REVIEW_SCHEMA

# Rows of a clustered version that one task sorts and writes, on average, at most.
FILE_ROWS = 25_000

CSV_OPTIONS = {
    "header": "true", "escape": '"', "quote": '"', "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _versions(spark: SparkSession, root: str, complete_only: bool = True) -> list[int]:
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("version=") and (not complete_only or fs.exists(
                jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def current_version(spark: SparkSession, root: str) -> int | None:
    v = _versions(spark, root)
    return v[-1] if v else None


def version_path(root: str, v: int) -> str:
    return f"{root.rstrip('/')}/version={v:06d}"


def _patch_root(root: str, v: int) -> str:
    return f"{root.rstrip('/')}/patches/version={v:06d}"


def _patches(spark: SparkSession, root: str, v: int, complete_only: bool = True) -> list[int]:
    fs, p, jvm = _fs(spark, _patch_root(root, v))
    if not fs.exists(p):
        return []
    return sorted(int(st.getPath().getName().split("=", 1)[1]) for st in fs.listStatus(p)
                  if st.getPath().getName().startswith("patch=") and (not complete_only or fs.exists(
                      jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))))


def patched_rows(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest patch row of every patched ID of the current version (None: no patch).  One partial
    aggregation over the patches; the base is not read."""
    v = current_version(spark, root)
    numbers = _patches(spark, root, v) if v is not None else []
    if not numbers:
        return None
    base = _patch_root(root, v)
    schema = T.StructType([*REVIEW_SCHEMA.fields, T.StructField("patch", T.IntegerType())])
    rows = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/patch={k:06d}" for k in numbers])
    names = [f.name for f in REVIEW_SCHEMA.fields]
    if len(numbers) == 1:
        return rows.select(*names)
    newest = F.max_by(F.struct(*[x for x in names if x != "ID"]), "patch")
    return rows.groupBy("ID").agg(newest.alias("_r")).select("ID", "_r.*").select(*names)


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The current version, patches laid over it.  Patched IDs are counted (they may hold an ID
    several times, which only makes the count safe) and broadcast while they are few."""
    v = current_version(spark, root)
    if v is None:
        return spark.createDataFrame([], REVIEW_SCHEMA)
    base = spark.read.schema(REVIEW_SCHEMA).parquet(version_path(root, v))
    patched = patched_rows(spark, root)
    if patched is None:
        return base
    ids = spark.read.schema("ID string").parquet(_patch_root(root, v)) \
        if _patches(spark, root, v) == _patches(spark, root, v, complete_only=False) else patched.select("ID")
    return merge_upsert(base, patched, validate=None, ids=ids, batch_rows=ids.count()).select(*base.columns)


def table_patch_sink(rows: DataFrame, root: str) -> int:
    """Write ``rows`` (unique, non-null IDs) as the next patch of the current version; returns its number.
    Rows replace those of their ID or are new.  Nothing of the table is read.  The first
    write of a table is a version."""
    spark = rows.sparkSession
    rows = rows.select(*[f.name for f in REVIEW_SCHEMA.fields])
    v = current_version(spark, root)
    if v is None:
        table_replace_sink(guard_unique_keys(rows), root)
        return 0
    k = max(_patches(spark, root, v, complete_only=False), default=0) + 1
    guard_unique_keys(rows).write.mode("errorifexists").parquet(f"{_patch_root(root, v)}/patch={k:06d}")
    return k


def compact(spark: SparkSession, root: str, buckets: int | None = None) -> int:
    """Version and patches as the next version (see ``table_replace_sink``)."""
    return table_replace_sink(read_table(spark, root), root, buckets)


def table_replace_sink(df: DataFrame, root: str, buckets: int | None = None) -> int:
    """Write ``df`` as the next version; returns the new version number.
    The number is past every version folder, complete or not, so a write that
    died part-way (no ``_SUCCESS``; never read) does not block the retry.
    ``buckets`` is the least number of files clustered by ID; where they would hold more than
    ``FILE_ROWS`` rows each (one count), every one is cut into as many as it takes."""
    spark = df.sparkSession
    v = max(_versions(spark, root, complete_only=False), default=0) + 1
    out = df.select(*[f.name for f in REVIEW_SCHEMA.fields])
    if buckets:
        buckets *= max(1, -(-out.count() // (buckets * FILE_ROWS)))
        out = out.repartition(buckets, "ID").sortWithinPartitions("ID")
    out.write.mode("errorifexists").parquet(version_path(root, v))
    return v


def table_sink(df: DataFrame, root: str) -> int:
    """Append rows to the current version (first write creates version 1)."""
    spark = df.sparkSession
    v = current_version(spark, root)
    if v is None:
        return table_replace_sink(df, root)
    df.select(*[f.name for f in REVIEW_SCHEMA.fields]).write.mode("append").parquet(
        version_path(root, v))
    return v


def csv_backup(table: DataFrame, directory: str, at: _dt.datetime) -> str:
    """Whole table as CSV with header under ``backup_<YYYY-MM-DD_HH-MM>``;
    quoting set so text with quotes, newlines and edge spaces reads back
    equal (read with ``read_csv_backup``).  NULL is written as an empty field
    and '' as ``""``, so the two stay apart."""
    path = f"{directory.rstrip('/')}/backup_{at.strftime('%Y-%m-%d_%H-%M')}"
    fs, p, jvm = _fs(table.sparkSession, path)
    # a complete backup is never replaced; one left by a crashed write is
    mode = "errorifexists" if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")) \
        else "overwrite"
    table.write.options(**CSV_OPTIONS).mode(mode).csv(path)
    return path


# Marker for a quoted empty field while reading: the reader would otherwise
# match ``""`` against ``nullValue`` ('') and return NULL for ''.
_EMPTY_MARK = "\u0000"


def read_csv_backup(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(REVIEW_SCHEMA).options(**CSV_OPTIONS, emptyValue=_EMPTY_MARK).csv(path)
    return raw.select(*[
        F.when(F.col(f.name) == _EMPTY_MARK, F.lit("")).otherwise(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in REVIEW_SCHEMA.fields])


def dupes_report(table: DataFrame, path: str, asof: _dt.date) -> DataFrame:
    """Duplicate keys with the as-of date, written as CSV; returns the frame."""
    rep = duplicate_ids(table).withColumn("asof", F.lit(asof))
    rep.write.options(header="true").mode("overwrite").csv(path)
    return rep


def run_log(events: DataFrame, path: str, stage: str, at: _dt.datetime) -> None:
    """Append ``(ts, stage, ID, reason)`` rows (named fields, Parquet)."""
    events.select(ts_literal(at).alias("ts"), F.lit(stage).alias("stage"),
                  F.col("ID"), F.col("reason")).write.mode("append").parquet(path)
