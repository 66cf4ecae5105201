"""Canonical review table: schema, declared widths and the fixed vocabularies.

The review table is one wide row per review keyed by ``ID``.  Types follow the
declared column types (string / date / datetime / int / float); declared
``nvarchar(n)`` widths have no Spark type and are kept in ``WIDTHS`` for the
``width_violations`` audit.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

S, D, I, F, TS = (T.StringType(), T.DateType(), T.IntegerType(), T.DoubleType(),
                  T.TimestampNTZType())

# Column order, types and declared widths of the review table.
# (name, type, declared width or None for MAX / non-text)
COLUMNS: list[tuple[str, T.DataType, int | None]] = [
    ("Portal", S, 10),
    ("ID", S, 50),
    ("Link", S, 255),
    ("ReviewTitle", S, 255),
    ("RefreshDate", D, None),
    ("ReviewDate", D, None),
    ("OnlineYesNo", S, 10),
    ("OverallSatisfaction", F, None),
    ("JobTitle", S, 50),
    ("Department", S, 50),
    ("CurrentFormerEmployee", S, 10),
    ("ContractTerminationKununuOnly", I, None),
    ("Location", S, 50),
    ("StateRegion", S, 50),
    ("Country", S, 50),
    ("Language", S, 10),
    ("ReviewText", S, None),
    ("ReviewTextEN", S, None),
    ("MainpositiveAspect", S, 255),
    ("MainAreaofImprovement", S, 255),
    ("SensitiveTopic", S, 10),
    ("ApprovalStatus", S, 30),
    ("ResponsePostedYesNo", S, 10),
    ("Response", S, None),
    ("ResponseEN", S, None),
    ("EditedResponse", S, None),
    ("EstResponseDate", D, None),
    ("ResponseTimeDays", I, None),
    ("EmpathyScore", F, None),
    ("HelpfulnessScore", F, None),
    ("IndividualityScore", F, None),
    ("OverallScore", F, None),
    ("WeightedScore", F, None),
    ("DeveloperComment", S, 255),
    ("last_modified", TS, None),
]

COLUMN_NAMES = [c for c, _, _ in COLUMNS]
WIDTHS = {c: w for c, _, w in COLUMNS if w is not None}

REVIEW_SCHEMA = T.StructType(
    [T.StructField(c, t, nullable=(c != "ID")) for c, t, _ in COLUMNS]
)

# Portal names as stored, in the order the sources are tried.
PORTALS = ["Indeed", "Glassdoor", "kununu"]

# The seven core reply languages; anything else is answered in
# German on kununu and in English elsewhere.
CORE_LANGUAGES = ["DE", "EN", "NL", "IT", "ES", "FR", "PT"]

# The closed category lists for the two aspect columns.
POSITIVE_ASPECTS = [
    "Career advancement",
    "Company in general",
    "Good / stable job",
    "Superiors",
    "Positive atmosphere",
    "Regular salary",
    "Colleagues",
    "Big company benefits",
    "Fair / good salary",
    "No stress",
    "Trust / autonomous work",
    "Professional development",
    "Flexibility / Work-life balance",
    "Collaboration",
    "Uncategorized",
    "Good organization",
    "Transparency",
    "Communication",
]
NEGATIVE_ASPECTS = [
    "Poor Salary",
    "Hard work / workload",
    "Uncategorized",
    "Boring tasks",
    "Old office / working place",
    "Big company disadvantages",
    "Intransparency",
    "Bad organization",
    "Contract / working conditions",
    "Company in general",
    "Old equipment / vehicles",
    "Flexibility / Work-life balance",
    "Colleagues",
    "Not enough manpower",
    "Career advancement",
    "Superiors",
    "Professional development",
    "Communication",
]

# Work-list parameters (days / rows).
NEW_REVIEW_REFRESH_DELAY = 14
SENSITIVE_REVIEW_REFRESH_FREQUENCY = 4
SENSITIVE_REVIEW_REFRESH_INTERVAL = 21
OLD_REVIEW_REFRESH_COUNT = 20
UNANSWERED_LOOKBACK_DAYS = 100
REGENERATE_BATCH = 10
TRANSLATE_BATCH = 20
COMPLETE_BATCH = 20
PINNED_REVIEW_MAX_AGE_DAYS = 7
TRANSLATION_TRIES = 3
REFRESH_ATTEMPTS = 10

# Model request parameters per request kind.
LANGUAGE_MAX_TOKENS = 50
REPLY_MAX_TOKENS = 1000

# As-of date of the test fixtures (the derived `reviews` view).
FIXTURE_ASOF = _dt.date(2024, 1, 31)


def empty_reviews(spark):
    """``schema_clone``: an empty frame with the table schema."""
    return spark.createDataFrame([], REVIEW_SCHEMA)
