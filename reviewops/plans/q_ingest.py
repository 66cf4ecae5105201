"""Registered ingest queries: landed pages -> feed rows -> canonical rows.

Spark path: feed fixture -> landed JSON pages -> ``feed_scan`` (clean, parse,
posexplode) -> operators.  DuckDB path: the flat feed, no JSON -- so a match
also checks the JSON round trip.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.html import css
from ..operators import ingest as I
from ..schema import FIXTURE_ASOF
from ..sources.feed import feed_scan
from ..sources.fixtures import EMPLOYMENT_CLASS, employment_pages, feed_pages
from .oracle import table_select, with_feed
from .registry import register

SINCE = _dt.datetime(2024, 1, 10)
NL2 = "chr(10) || chr(10)"


def _feed(spark, sf):
    return feed_scan(feed_pages(spark, sf))


VALID = "lower(portal) IN ('indeed', 'glassdoor', 'kununu')"


@register("feed_scan", with_feed(
    "SELECT run_id, portal, lang, page, pos, id, title, datetime, rating, text FROM feed"))
def q_feed_scan(spark, sf):
    return _feed(spark, sf).select("run_id", "portal", "lang", "page", "pos", "id", "title", "datetime",
                                   "rating", "text")


@register("feed_body_clean", with_feed(
    "SELECT run_id, portal, lang, page, count(*) AS reviews, CAST(sum(length(text)) AS BIGINT) AS characters FROM feed"
    " GROUP BY run_id, portal, lang, page"))
def q_feed_body_clean(spark, sf):
    return _feed(spark, sf).groupBy("run_id", "portal", "lang", "page").agg(
        F.count(F.lit(1)).alias("reviews"), F.sum(F.length("text")).alias("characters"))


@register("portal_guard", with_feed(
    "SELECT portal, page, pos, id, '\"' || portal || '\" is not a supported portal' AS reason"
    f" FROM feed WHERE NOT {VALID}"))
def q_portal_guard(spark, sf):
    return I.portal_guard(_feed(spark, sf))[1]


_NOT_PINNED = ("NOT coalesce(lower(portal) = 'indeed' AND pos = 0"
               " AND ts < TIMESTAMP '2024-01-24 00:00:00', false)")


@register("drop_pinned_first", with_feed(
    f"SELECT portal, page, pos, id FROM feed WHERE {VALID} AND {_NOT_PINNED}"))
def q_drop_pinned_first(spark, sf):
    valid, _ = I.portal_guard(_feed(spark, sf))
    return I.drop_pinned_first(I.feed_ts(valid), FIXTURE_ASOF).select("portal", "page", "pos", "id")


_SEQ = "page * 1000000 + pos"
_OLD = "ts < TIMESTAMP '2024-01-10 00:00:00'"


@register("feed_prefix_global", with_feed(
    f"SELECT np.portal, np.page, np.pos, np.id FROM np LEFT JOIN cuts USING (run_id, portal, lang)"
    f" WHERE cut IS NULL OR {_SEQ.replace('page', 'np.page').replace('pos', 'np.pos')} < cut",
    f"np AS (SELECT * FROM feed WHERE lower(portal) IN ('indeed', 'kununu') AND {_NOT_PINNED})",
    f"cuts AS (SELECT run_id, portal, lang, min(CASE WHEN {_OLD} THEN {_SEQ} END) AS cut"
    " FROM np GROUP BY run_id, portal, lang)"))
def q_feed_prefix_global(spark, sf):
    valid, _ = I.portal_guard(_feed(spark, sf))
    f = I.drop_pinned_first(I.feed_ts(valid), FIXTURE_ASOF)
    f = f.filter(F.lower("portal").isin("indeed", "kununu"))
    return I.feed_prefix(f, SINCE, "feed").select("portal", "page", "pos", "id")


@register("feed_prefix_page", with_feed(
    f"SELECT np.portal, np.page, np.pos, np.id FROM np LEFT JOIN cuts USING (run_id, portal, lang, page)"
    f" WHERE cut IS NULL OR {_SEQ.replace('page', 'np.page').replace('pos', 'np.pos')} < cut",
    "np AS (SELECT * FROM feed WHERE lower(portal) = 'glassdoor')",
    f"cuts AS (SELECT run_id, portal, lang, page, min(CASE WHEN {_OLD} THEN {_SEQ} END) AS cut"
    " FROM np GROUP BY run_id, portal, lang, page)"))
def q_feed_prefix_page(spark, sf):
    f = I.feed_ts(_feed(spark, sf)).filter(F.lower("portal") == "glassdoor")
    return I.feed_prefix(f, SINCE, "page").select("portal", "page", "pos", "id")


_TS_DATE = "CAST(ts AS DATE)"
_COMMON = {
    "ID": "id", "Link": "url", "ReviewTitle": "title", "ReviewDate": _TS_DATE,
    "RefreshDate": "DATE '2024-01-31'", "OnlineYesNo": "'Yes'",
    "OverallSatisfaction": "TRY_CAST(rating AS DOUBLE)", "ResponsePostedYesNo": "'No'",
}
_INDEED = dict(_COMMON, Portal="'Indeed'", JobTitle="reviewer",
               CurrentFormerEmployee="split_part(reviewer_employee_type, ' ', 1)",
               Location="location",
               ReviewText=f"concat_ws({NL2}, CASE WHEN pros <> '' THEN 'Pros: ' || pros END,"
                          " CASE WHEN cons <> '' THEN 'Cons: ' || cons END, text)")
_GLASSDOOR = dict(_COMMON, Portal="'Glassdoor'", JobTitle="reviewer",
                  CurrentFormerEmployee="CASE WHEN is_current_job THEN 'Current' ELSE 'Former' END",
                  Location="location",
                  ReviewText="CASE WHEN coalesce(pros, '') = '' AND coalesce(cons, '') = '' THEN NULL"
                             f" ELSE concat_ws({NL2}, CASE WHEN pros <> '' THEN 'Pros: ' || pros END,"
                             " CASE WHEN cons <> '' THEN 'Cons: ' || cons END) END")
_SCORES = (f"{NL2} || 'salary rating: ' || CAST(salary_rating AS VARCHAR) || '/5 ' || coalesce(salary_text, '')"
           " || chr(10) || 'work life rating: ' || CAST(work_life_rating AS VARCHAR) || '/5 '"
           " || coalesce(work_life_text, '')")
_KUNUNU = dict(_COMMON, Portal="'kununu'", Location="company_city",
               ReviewText=f"coalesce(text, '') || CASE WHEN coalesce(text, '') = '' THEN substr({_SCORES}, 3)"
                          f" ELSE {_SCORES} END",
               Response="reply_text",
               ResponsePostedYesNo="CASE WHEN coalesce(reply_text, '') <> '' THEN 'Yes' ELSE 'No' END",
               ApprovalStatus="CASE WHEN coalesce(reply_text, '') <> '' THEN 'Approved' END")


@register("normalize_indeed", with_feed(
    f"SELECT {table_select(_INDEED)} FROM feed WHERE lower(portal) = 'indeed'"))
def q_normalize_indeed(spark, sf):
    return I.normalize_indeed(_feed(spark, sf), FIXTURE_ASOF)


@register("normalize_glassdoor", with_feed(
    f"SELECT {table_select(_GLASSDOOR)} FROM feed WHERE lower(portal) = 'glassdoor'"))
def q_normalize_glassdoor(spark, sf):
    return I.normalize_glassdoor(_feed(spark, sf), FIXTURE_ASOF)


@register("normalize_kununu", with_feed(
    f"SELECT {table_select(_KUNUNU)} FROM feed WHERE lower(portal) = 'kununu'"))
def q_normalize_kununu(spark, sf):
    return I.normalize_kununu(_feed(spark, sf), FIXTURE_ASOF)


@register("null_template", with_feed(
    f"SELECT {table_select({'ID': 'id', 'Portal': 'portal'})} FROM feed"))
def q_null_template(spark, sf):
    from ..operators.merge import schema_conform
    return schema_conform(_feed(spark, sf).select(F.col("id").alias("ID"),
                                                  F.col("portal").alias("Portal")))


@register("extract_new_reviews", with_feed(
    f"SELECT {table_select(_INDEED)} FROM win WHERE lower(portal) = 'indeed'"
    f" UNION ALL SELECT {table_select(_GLASSDOOR)} FROM win WHERE lower(portal) = 'glassdoor'"
    f" UNION ALL SELECT {table_select(_KUNUNU)} FROM win WHERE lower(portal) = 'kununu'",
    f"np AS (SELECT * FROM feed WHERE {VALID} AND {_NOT_PINNED})",
    f"gcut AS (SELECT run_id, portal, lang, min(CASE WHEN {_OLD} THEN {_SEQ} END) AS cut FROM np"
    " WHERE lower(portal) <> 'glassdoor' GROUP BY run_id, portal, lang)",
    f"pcut AS (SELECT run_id, portal, lang, page, min(CASE WHEN {_OLD} THEN {_SEQ} END) AS cut FROM np"
    " WHERE lower(portal) = 'glassdoor' GROUP BY run_id, portal, lang, page)",
    "win AS (SELECT np.* FROM np LEFT JOIN gcut USING (run_id, portal, lang) WHERE lower(np.portal) <> 'glassdoor'"
    " AND (gcut.cut IS NULL OR np.page * 1000000 + np.pos < gcut.cut)"
    " UNION ALL SELECT np.* FROM np LEFT JOIN pcut USING (run_id, portal, lang, page)"
    " WHERE lower(np.portal) = 'glassdoor' AND (pcut.cut IS NULL OR np.page * 1000000 + np.pos < pcut.cut))"))
def q_extract_new_reviews(spark, sf):
    return I.extract_landed(feed_pages(spark, sf), SINCE, FIXTURE_ASOF)


@register("parse_feed_ts", with_feed("SELECT id, datetime, ts FROM feed"))
def q_parse_feed_ts(spark, sf):
    return _feed(spark, sf).select("id", "datetime", TX.parse_feed_ts(F.col("datetime")).alias("ts"))


@register("first_word", with_feed(
    "SELECT id, split_part(reviewer_employee_type, ' ', 1) AS employee_type FROM feed"))
def q_first_word(spark, sf):
    return _feed(spark, sf).select("id", TX.first_word(F.col("reviewer_employee_type"))
                                   .alias("employee_type"))


@register("current_former", with_feed(
    "SELECT id, CASE WHEN is_current_job THEN 'Current' ELSE 'Former' END AS from_flag,"
    " CASE WHEN contains(reviewer_employee_type, 'Ex-') OR contains(title, 'Ex-') THEN 'Former'"
    " ELSE 'Current' END AS from_title FROM feed"))
def q_current_former(spark, sf):
    f = _feed(spark, sf)
    return f.select("id", TX.current_former_from_flag(F.col("is_current_job")).alias("from_flag"),
                    TX.current_former_from_title(F.concat_ws(" ", "reviewer_employee_type", "title"))
                    .alias("from_title"))


@register("compose_text", with_feed(
    f"SELECT id, {_INDEED['ReviewText']} AS indeed_text, {_GLASSDOOR['ReviewText']} AS glassdoor_text"
    " FROM feed"))
def q_compose_text(spark, sf):
    f = _feed(spark, sf)
    return f.select("id", TX.compose_indeed_text(F.col("pros"), F.col("cons"), F.col("text"))
                    .alias("indeed_text"),
                    TX.compose_glassdoor_text(F.col("pros"), F.col("cons")).alias("glassdoor_text"))


@register("rating_labels", with_feed(
    f"SELECT id, CASE WHEN coalesce(text, '') = '' THEN substr({_SCORES}, 3) ELSE {_SCORES} END"
    " AS labels FROM feed WHERE lower(portal) = 'kununu'"))
def q_rating_labels(spark, sf):
    f = _feed(spark, sf).filter(F.lower("portal") == "kununu")
    return f.select("id", TX.rating_labels(F.col("raw"), F.col("text")).alias("labels"))


_EMP_HTML = (
    "'<html><body>' || CASE WHEN doc_id % 10 = 3 THEN '' ELSE"
    f" '<div class=\"{EMPLOYMENT_CLASS}\"><b>' || CASE WHEN doc_id % 6 = 2 THEN 'Ex-' || reviewer ELSE reviewer END"
    " || '</b>' || CASE WHEN doc_id % 9 = 1 THEN '' ELSE '<span>Angestellte/r im Bereich '"
    " || upper(substr(lang, 1, 1)) || lower(substr(lang, 2)) || ' bei Firma'"
    " || CASE WHEN doc_id % 4 = 0 THEN ', bis ' || CAST(2015 + doc_id % 9 AS VARCHAR) || ' ' ELSE '' END"
    " || '</span>' END || '</div>' END || '</body></html>'")


@register("employment_block", with_feed(
    "SELECT id AS ID,"
    " CASE WHEN ok THEN b END AS JobTitle,"
    " CASE WHEN ok THEN CASE WHEN contains(b, 'Ex-') THEN 'Former' ELSE 'Current' END END AS CurrentFormerEmployee,"
    " CASE WHEN ok AND contains(s, 'im Bereich') THEN split_part(split_part(s, 'im Bereich ', 2), ' bei', 1) END"
    "   AS Department,"
    " CASE WHEN ok THEN TRY_CAST(nullif(regexp_extract(s, ' (2[0-9]{3}) ', 1), '') AS INTEGER) END"
    "   AS ContractTerminationKununuOnly"
    " FROM (SELECT id, blk IS NOT NULL AND b IS NOT NULL AND s IS NOT NULL AS ok, b, s FROM ("
    "  SELECT id, blk,"
    "   CASE WHEN regexp_matches(blk, '(?s)<(b)(?:\\s[^>]*)?>(.*?)</b>') THEN regexp_extract(blk, '(?s)<(b)(?:\\s[^>]*)?>(.*?)</b>', 2) END AS b,"
    "   CASE WHEN regexp_matches(blk, '(?s)<(span)(?:\\s[^>]*)?>(.*?)</span>') THEN regexp_extract(blk, '(?s)<(span)(?:\\s[^>]*)?>(.*?)</span>', 2) END AS s"
    "  FROM (SELECT id, CASE WHEN regexp_matches(html, '(?s)<(div)\\s[^>]*class=\"employment-info\"[^>]*>(.*?)</div>')"
    "    THEN regexp_extract(html, '(?s)<(div)\\s[^>]*class=\"employment-info\"[^>]*>(.*?)</div>', 2) END AS blk"
    f"    FROM (SELECT id, {_EMP_HTML} AS html FROM feed"
    "     WHERE lower(portal) = 'kununu'))))"))
def q_employment_block(spark, sf):
    f = _feed(spark, sf)
    rows = I.normalize_kununu(f, FIXTURE_ASOF)
    out = I.supplement_kununu(rows, employment_pages(spark, sf), css(EMPLOYMENT_CLASS, tag="div"))
    return out.select("ID", "JobTitle", "CurrentFormerEmployee", "Department",
                      "ContractTerminationKununuOnly")
