"""Landed review feeds.

A landed record is one fetched page: ``run_id, portal, lang, page, body`` where
``run_id`` names the feed run (one call of the fetcher; ids sort by time) and
``body`` is the service's JSON text ``{"reviews": [...]}``.  Pages without a run
id belong to one run of their own.  Records are stored
as JSON lines (or Parquet); Spark reads them with an explicit schema and
splits files across tasks.  The body is cleaned (raw line feeds -> space,
carriage returns removed) and parsed with ``reviews`` as ``array<string>``, so
each review keeps its raw JSON text (needed for the open set of
``*_rating`` keys) next to the typed fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LANDED_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("portal", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("page", T.LongType()),
    T.StructField("body", T.StringType()),
])

# Typed view of one review object; portal-specific fields are NULL elsewhere.
REVIEW_STRUCT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("datetime", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("reviewer", T.StringType()),
    T.StructField("reviewer_employee_type", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("pros", T.StringType()),
    T.StructField("cons", T.StringType()),
    T.StructField("is_current_job", T.BooleanType()),
    T.StructField("company", T.StructType([T.StructField("city", T.StringType())])),
    T.StructField("reply", T.StructType([T.StructField("text", T.StringType())])),
])

_JSON_OPTS = {"allowSingleQuotes": "false"}


def feed_body_clean(body: Column) -> Column:
    """Raw line feed -> space, carriage return removed (before JSON parsing)."""
    return F.replace(F.replace(body, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(""))


def landed_scan(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(LANDED_SCHEMA).format(fmt).load(path)


PAGE_KEYS = ["run_id", "portal", "lang", "page"]


def page_scan(landed: DataFrame) -> DataFrame:
    """One row per landed page that parses: its keys and ``reviews``, the raw
    JSON text of each review in page order."""
    return landed.select(
        F.coalesce("run_id", F.lit("")).alias("run_id"), "portal", "lang", "page",
        F.from_json(feed_body_clean(F.col("body")), "struct<reviews: array<string>>",
                    _JSON_OPTS)["reviews"].alias("reviews")).filter("reviews IS NOT NULL")


def typed_reviews(rows: DataFrame) -> DataFrame:
    """Typed fields next to the raw JSON text of each review row."""
    return rows.select(*PAGE_KEYS, "pos", "raw",
                       F.from_json("raw", REVIEW_STRUCT, _JSON_OPTS).alias("r")) \
        .select(*PAGE_KEYS, "pos", "raw", "r.*")


def feed_scan(landed: DataFrame) -> DataFrame:
    """One row per review: landed keys, ``pos`` in page, raw JSON and the
    typed fields.  Pages whose body does not parse yield no rows (they are
    reported by ``feed_rejects``); an empty page yields no rows."""
    return typed_reviews(page_scan(landed).select(
        *PAGE_KEYS, F.posexplode("reviews").alias("pos", "raw")))


def feed_rejects(landed: DataFrame) -> DataFrame:
    """Landed pages whose body is not a JSON object with a ``reviews`` array."""
    p = F.from_json(feed_body_clean(F.col("body")), "struct<reviews: array<string>>", _JSON_OPTS)
    return landed.filter(p.isNull() | p["reviews"].isNull()) \
        .select("portal", "lang", "page", F.lit("unparsable page").alias("reason"))
