"""Table scans.

The review table lives as Parquet (one directory per committed version, see
``reviewops.sinks.table``).  Test inputs are the driver tables under an
``sf_dir``; every scan is a plain ``spark.read.parquet`` so Catalyst can push
filters and prune columns into the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import REVIEW_SCHEMA

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_scan(spark: SparkSession, path: str) -> DataFrame:
    """Read the review table (all columns; callers project what they need)."""
    return spark.read.schema(REVIEW_SCHEMA).parquet(path)


def table_scan_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None
                    ) -> DataFrame:
    """Same read for users who keep the table in a database (no driver bundled)."""
    return spark.read.jdbc(url, table, properties=properties or {})
