"""Registered query: language of every document by ranked n-gram profiles, a quarter of the documents held out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators import profiles as P
from ..session import ensure_parallelism
from ..sources.tables import load
from .registry import register

SQL = rf"""
WITH docs AS (
  SELECT doc_id, text, lang, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '4' AS held_out FROM documents
),
words AS (
  SELECT doc_id, word, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM docs)
  GROUP BY ALL
),
cuts AS (
  SELECT doc_id, word, n, k, unnest(generate_series(1, length(word) + 3 - k)) AS i
  FROM words CROSS JOIN (VALUES (1), (2), (3)) AS size(k)
),
grams AS (
  SELECT doc_id, substr('_' || word || '_', i, k) AS gram, sum(n) AS n FROM cuts GROUP BY ALL
),
taught AS (
  SELECT lang, gram, sum(n) AS n FROM grams JOIN docs USING (doc_id)
  WHERE NOT held_out AND lang IS NOT NULL GROUP BY ALL
),
profile AS (
  SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) - 1 AS place
  FROM taught QUALIFY place < {P.SIZE}
),
own AS (
  SELECT doc_id, gram, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, gram) - 1 AS place
  FROM grams QUALIFY place < {P.SIZE}
),
distances AS (
  SELECT o.doc_id, l.lang, sum(coalesce(abs(o.place - p.place), {P.SIZE})) AS distance
  FROM own o CROSS JOIN (SELECT DISTINCT lang FROM profile) l
  LEFT JOIN profile p ON p.lang = l.lang AND p.gram = o.gram
  GROUP BY ALL
),
nearest AS (
  SELECT doc_id, lang AS lang_pred, distance AS lang_distance FROM distances
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY distance, lang) = 1
)
SELECT doc_id, held_out, coalesce(lang_pred, 'und') AS lang_pred, CAST(lang_distance AS BIGINT) AS lang_distance
FROM docs LEFT JOIN nearest USING (doc_id)
"""


def held_out(key: Column) -> Column:
    """A quarter of the keys, by the first hexadecimal digit of their MD5."""
    return F.substring(F.md5(key.cast("string")), 1, 1) < "4"


@register("detect_language_profiles", SQL)
def q_detect_language_profiles(spark, sf):
    docs = ensure_parallelism(load(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    profiles = P.language_profiles(docs.filter("NOT held_out"), "text", "lang")
    return P.detect_by_profile(docs.drop("lang"), profiles, "text").drop("text")
