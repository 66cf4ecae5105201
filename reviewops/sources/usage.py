"""Usage report: a window of service usage records.

The service delivers the report as gzip-compressed JSON; Spark reads ``.gz``
transparently and splits work by file.  The window is ``start <= ts < end``
(both given as midnight timestamps; the end is exclusive).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ts_literal

REPORT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def usage_report_scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_SCHEMA).json(path)


def usage_window(records: DataFrame, start: _dt.datetime, end: _dt.datetime) -> DataFrame:
    """Records in ``[start, end)``; the filter reaches the Parquet/JSON scan."""
    ts = F.col("ts")
    return records.filter((ts >= ts_literal(start)) & (ts < ts_literal(end))) \
        .select("event_id", "ts", "user_id", "event_type", "value")
