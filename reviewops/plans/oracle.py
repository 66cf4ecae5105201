"""DuckDB SQL twins of the derived fixtures (written independently of the
DataFrame code in ``reviewops.sources.fixtures``).  Views ``documents``,
``labels``, ``pages``, ``conversations``, ``nation``, ``region``, ``events``
are registered by the checker."""

from __future__ import annotations

ASOF = "DATE '2024-01-31'"

REVIEW_CTES = r"""
reply AS (
  SELECT conv_id, arg_min(text, turn) AS reply
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id
),
base AS (
  SELECT d.doc_id, d.text, d.lang, d.source, l.toxic, p.url, r.reply, n.n_name,
         CASE d.doc_id % 3 WHEN 0 THEN 'Indeed' WHEN 1 THEN 'Glassdoor' ELSE 'kununu' END AS portal,
         CAST(DATE '2024-01-31' - CAST((d.doc_id * 7) % 45 AS INTEGER) AS DATE) AS rdate
  FROM documents d
  LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN pages p ON p.page_id = d.doc_id
  LEFT JOIN reply r ON r.conv_id = d.doc_id // 10
  LEFT JOIN nation n ON n.n_nationkey = d.doc_id % 25
),
reviews AS (
  SELECT
    portal AS Portal,
    lower(portal) || '-' || CAST(doc_id AS VARCHAR) AS ID,
    url AS Link,
    'Review ' || CAST(doc_id AS VARCHAR) || ' by ' || source AS ReviewTitle,
    CASE WHEN doc_id % 17 = 0 THEN NULL
         ELSE CAST(rdate + CAST(doc_id % 5 AS INTEGER) AS DATE) END AS RefreshDate,
    rdate AS ReviewDate,
    CASE doc_id % 7 WHEN 0 THEN 'No' WHEN 1 THEN NULL ELSE 'Yes' END AS OnlineYesNo,
    CAST(1 + doc_id % 5 AS DOUBLE) AS OverallSatisfaction,
    source AS JobTitle,
    CAST(NULL AS VARCHAR) AS Department,
    CAST(NULL AS VARCHAR) AS CurrentFormerEmployee,
    CAST(NULL AS INTEGER) AS ContractTerminationKununuOnly,
    CASE WHEN doc_id % 6 = 0 THEN NULL ELSE n_name END AS Location,
    CAST(NULL AS VARCHAR) AS StateRegion,
    CAST(NULL AS VARCHAR) AS Country,
    CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN 'PL' ELSE upper(lang) END AS Language,
    CASE portal
      WHEN 'Indeed' THEN 'Pros: ' || source || chr(10) || chr(10) || 'Cons: ' || lang || chr(10) || chr(10) || text
      WHEN 'kununu' THEN (CASE WHEN doc_id % 12 = 2 THEN '' ELSE text END) || chr(10) || chr(10)
           || 'atmosphere rating: ' || CAST(1 + doc_id % 5 AS VARCHAR) || '/5 ' || chr(10)
           || 'salary rating: ' || CAST(1 + doc_id % 4 AS VARCHAR) || '/5 '
      ELSE text END AS ReviewText,
    CASE WHEN doc_id % 2 = 0 THEN text END AS ReviewTextEN,
    CAST(NULL AS VARCHAR) AS MainpositiveAspect,
    CAST(NULL AS VARCHAR) AS MainAreaofImprovement,
    CASE toxic WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS SensitiveTopic,
    CASE WHEN doc_id % 13 = 0 THEN 'Regenerate'
         WHEN doc_id % 5 < 2 OR reply IS NULL THEN NULL
         WHEN doc_id % 3 = 0 THEN 'Pending'
         WHEN doc_id % 4 = 1 THEN 'ApplyNewResponse'
         ELSE 'Approved' END AS ApprovalStatus,
    CASE WHEN doc_id % 5 >= 2 AND reply IS NOT NULL AND doc_id % 2 = 0 THEN 'Yes' ELSE 'No' END
      AS ResponsePostedYesNo,
    CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE reply END AS Response,
    CASE WHEN doc_id % 3 = 1 AND doc_id % 5 >= 2 THEN reply END AS ResponseEN,
    CAST(NULL AS VARCHAR) AS EditedResponse,
    CAST(NULL AS DATE) AS EstResponseDate,
    CAST(NULL AS INTEGER) AS ResponseTimeDays,
    CAST(NULL AS DOUBLE) AS EmpathyScore,
    CAST(NULL AS DOUBLE) AS HelpfulnessScore,
    CAST(NULL AS DOUBLE) AS IndividualityScore,
    CAST(NULL AS DOUBLE) AS OverallScore,
    CAST(NULL AS DOUBLE) AS WeightedScore,
    CAST(NULL AS VARCHAR) AS DeveloperComment,
    CAST(NULL AS TIMESTAMP) AS last_modified
  FROM base
)"""

# The review columns in table order (for explicit select lists).
COLS = ("Portal, ID, Link, ReviewTitle, RefreshDate, ReviewDate, OnlineYesNo, OverallSatisfaction, "
        "JobTitle, Department, CurrentFormerEmployee, ContractTerminationKununuOnly, Location, "
        "StateRegion, Country, Language, ReviewText, ReviewTextEN, MainpositiveAspect, "
        "MainAreaofImprovement, SensitiveTopic, ApprovalStatus, ResponsePostedYesNo, Response, "
        "ResponseEN, EditedResponse, EstResponseDate, ResponseTimeDays, EmpathyScore, "
        "HelpfulnessScore, IndividualityScore, OverallScore, WeightedScore, DeveloperComment, "
        "last_modified")


def with_reviews(body: str, *ctes: str) -> str:
    """``WITH <review ctes>[, extra ctes] <body>``."""
    extra = "".join(",\n" + c for c in ctes)
    return f"WITH {REVIEW_CTES}{extra}\n{body}"


# SQL type of every review column (for NULL defaults in table-shaped selects).
_SQL_TYPES = {
    "RefreshDate": "DATE", "ReviewDate": "DATE", "EstResponseDate": "DATE",
    "OverallSatisfaction": "DOUBLE", "EmpathyScore": "DOUBLE", "HelpfulnessScore": "DOUBLE",
    "IndividualityScore": "DOUBLE", "OverallScore": "DOUBLE", "WeightedScore": "DOUBLE",
    "ContractTerminationKununuOnly": "INTEGER", "ResponseTimeDays": "INTEGER",
    "last_modified": "TIMESTAMP",
}


def table_select(overrides: dict[str, str]) -> str:
    """Select list in table order: given expressions, typed NULL elsewhere."""
    out = []
    for c in [x.strip() for x in COLS.split(",")]:
        t = _SQL_TYPES.get(c, "VARCHAR")
        out.append(f"CAST({overrides[c]} AS {t}) AS {c}" if c in overrides
                   else f"CAST(NULL AS {t}) AS {c}")
    return ", ".join(out)


FEED_CTES = r"""
feed0 AS (
  SELECT *, CASE WHEN doc_id % 50 = 7 THEN 'xing' WHEN doc_id % 3 = 0 THEN 'indeed'
                 WHEN doc_id % 3 = 1 THEN 'Glassdoor' ELSE 'KUNUNU' END AS fportal
  FROM base
),
feed AS (
  SELECT doc_id, CASE WHEN ((doc_id // 3) // 20) % 2 = 0 THEN 'run-1' ELSE 'run-2' END AS run_id, fportal AS portal,
    CASE WHEN lower(fportal) = 'glassdoor' THEN lang ELSE 'all' END AS lang,
    ((doc_id // 3) // 20) // 2 AS page,
    CAST(row_number() OVER (PARTITION BY fportal, CASE WHEN lower(fportal) = 'glassdoor' THEN lang
         ELSE 'all' END, (doc_id // 3) // 20 ORDER BY doc_id) - 1 AS INTEGER) AS pos,
    CAST(doc_id AS VARCHAR) AS id,
    url,
    source || ' ' || lang AS title,
    CASE WHEN doc_id % 97 = 5 THEN 'n/a'
         ELSE CAST(rdate AS VARCHAR) || 'T' || lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || ':'
              || lpad(CAST(doc_id % 60 AS VARCHAR), 2, '0') || ':'
              || lpad(CAST((doc_id * 7) % 60 AS VARCHAR), 2, '0')
              || CASE WHEN doc_id % 2 = 0 THEN '.' || CAST(doc_id % 1000 AS VARCHAR) ELSE '' END
    END AS datetime,
    CAST(1 + doc_id % 5 AS VARCHAR) AS rating,
    CASE WHEN doc_id % 12 = 2 THEN '' WHEN doc_id % 5 = 1 THEN replace(text, chr(10), ' ') ELSE text END AS text,
    source AS reviewer,
    CASE WHEN doc_id % 2 = 0 THEN 'Current Employee' ELSE 'Former Employee' END AS reviewer_employee_type,
    n_name AS location,
    CASE WHEN doc_id % 4 < 2 THEN url END AS pros,
    CASE WHEN doc_id % 8 < 4 THEN lang END AS cons,
    CASE WHEN doc_id % 10 = 9 THEN NULL ELSE doc_id % 2 = 0 END AS is_current_job,
    n_name AS company_city,
    CASE WHEN doc_id % 5 >= 2 THEN reply WHEN doc_id % 5 = 1 THEN '' END AS reply_text,
    1 + doc_id % 4 AS salary_rating,
    CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN NULL ELSE source END AS salary_text,
    1 + doc_id % 5 AS work_life_rating,
    CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN NULL ELSE lang END AS work_life_text,
    try_strptime(split_part(CASE WHEN doc_id % 97 = 5 THEN 'n/a'
         ELSE CAST(rdate AS VARCHAR) || 'T' || lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || ':'
              || lpad(CAST(doc_id % 60 AS VARCHAR), 2, '0') || ':'
              || lpad(CAST((doc_id * 7) % 60 AS VARCHAR), 2, '0') END, '.', 1),
         '%Y-%m-%dT%H:%M:%S') AS ts
  FROM feed0
)"""


def with_feed(body: str, *ctes: str) -> str:
    return with_reviews(body, FEED_CTES, *ctes)
