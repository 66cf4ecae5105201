"""Registered page, refresh, scalar and audit queries."""

from __future__ import annotations

import datetime as _dt
import uuid
from html.entities import name2codepoint

from pyspark.sql import functions as F

from ..functions.html import Selector, block_text, css
from ..functions.text import blank_or_null
from ..operators import audit as A
from ..operators import ingest as I
from ..operators import refresh as R
from ..operators import worklists as W
from ..schema import CORE_LANGUAGES, FIXTURE_ASOF, WIDTHS
from ..sources import usage
from ..sources.feed import feed_scan
from ..sources.fixtures import feed_pages, page_fetches, reviews
from ..session import ensure_parallelism, scratch_path
from ..sources.tables import load
from . import sqlgen as G
from .oracle import table_select, with_feed, with_reviews
from .q_ingest import _GLASSDOOR, _INDEED, _KUNUNU
from .registry import register

# The twin decodes with Python's own table, one reference after each "&".
_NAMED = "MAP {" + ", ".join(f"{G.q(k)}: {G.q(v)}" for k, v in [
    *((k, " " if k == "nbsp" else chr(v)) for k, v in sorted(name2codepoint.items())), ("apos", "'")]) + "}"


def _html_text_sql(inner: str) -> str:
    t = f"regexp_replace({inner}, '(?i)<br\\s*/?>', {G.NL}, 'g')"
    t = f"regexp_replace({t}, '(?s)<[^>]*>', '', 'g')"
    ref = "regexp_extract(p, '^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);', 1)"
    code = (f"CASE WHEN {ref} LIKE '#x%' OR {ref} LIKE '#X%' THEN TRY_CAST('0x' || {ref}[3:] AS INTEGER)"
            f" WHEN {ref} LIKE '#%' THEN TRY_CAST({ref}[2:] AS INTEGER) END")
    char = (f"CASE WHEN {code} = 160 THEN ' ' WHEN {code} BETWEEN 1 AND 1114111 AND NOT {code} BETWEEN 55296 AND 57343"
            f" THEN chr({code}) ELSE ({_NAMED})[{ref}] END")
    piece = f"CASE WHEN {char} IS NULL THEN '&' || p ELSE {char} || p[length({ref}) + 2:] END"
    return (f"(SELECT string_split(t, '&')[1] || array_to_string([{piece} FOR p IN string_split(t, '&')[2:]], '')"
            f" FROM (SELECT {t} AS t))")


def _inner_sql(html: str, open_re: str, tag: str) -> str:
    pat = f"(?s){open_re}(.*?)</{tag}>"
    return f"CASE WHEN regexp_matches({html}, {G.q(pat)}) THEN regexp_extract({html}, {G.q(pat)}, 2) END"


# References that the pages themselves lack: umlauts, numeric forms, unknown and broken ones.
REFERENCES = ("f&uuml;r M&auml;nner &#8211; gro&szlig; &#x1F600; &amp;lt; &bogus; & x &#0; &#xD800; &#9999999;"
              " &nbsp;&apos;&euro")
ARTICLE = "<(article)(?:\\s[^>]*)?>"
AD_DIV = '<(div)\\s[^>]*class="ad"[^>]*>'


@register("html_block_text", with_reviews(
    f"SELECT page_id, {_html_text_sql(_inner_sql('html', ARTICLE, 'article'))} AS text FROM"
    f" (SELECT page_id, replace(html, '</article>', {G.q(REFERENCES + '</article>')}) AS html FROM pages)"))
def q_html_block_text(spark, sf):
    p = ensure_parallelism(load(spark, sf, "pages"), "page_id")
    html = F.replace("html", F.lit("</article>"), F.lit(REFERENCES + "</article>"))
    return p.select("page_id", block_text(html, Selector(tag="article")).alias("text"))


# Page structure of the fixture pages: the review is the <article>; Indeed
# looks for the ad box inside it (absent -> posted No), Glassdoor for a
# <section> that does not exist (parse error), kununu for the ad box anywhere.
FIXTURE_PAGES = {
    "indeed": R.PortalPage(review=Selector(tag="article"), reply=css("ad", "div")),
    "glassdoor": R.PortalPage(review=Selector(tag="section"), reply=css("ad", "div")),
    "kununu": R.PortalPage(review=None, reply=css("ad", "div")),
}

_FETCH = (
    "fetches AS (SELECT lower(CASE page_id % 3 WHEN 0 THEN 'Indeed' WHEN 1 THEN 'Glassdoor'"
    " ELSE 'kununu' END) || '-' || CAST(page_id AS VARCHAR) AS ID, 1 AS attempt,"
    " CASE WHEN page_id % 9 = 0 THEN 404 WHEN page_id % 9 = 1 THEN 500 ELSE 200 END AS status,"
    " CASE WHEN page_id % 9 >= 2 THEN html END AS html FROM pages"
    " UNION ALL SELECT lower(CASE page_id % 3 WHEN 0 THEN 'Indeed' WHEN 1 THEN 'Glassdoor'"
    " ELSE 'kununu' END) || '-' || CAST(page_id AS VARCHAR), 2, 200, html FROM pages WHERE page_id % 27 = 1)")
_TERM = ("term AS (SELECT ID, coalesce(arg_min(status, attempt) FILTER (WHERE status BETWEEN 200 AND 299"
         " OR status = 404), arg_max(status, attempt)) AS _status,"
         " arg_min(html, attempt) FILTER (WHERE status BETWEEN 200 AND 299 OR status = 404) AS _html"
         " FROM fetches WHERE attempt <= 10 GROUP BY ID)")
_ONLINE = "(OnlineYesNo IS NULL OR OnlineYesNo = 'Yes')"
_WL = (
    "wl AS (SELECT * EXCLUDE (rn, pri) FROM (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY pri) AS rn"
    " FROM (SELECT *, 1 AS pri FROM reviews WHERE ReviewDate = DATE '2024-01-31' - 14 AND " + _ONLINE +
    " UNION ALL SELECT *, 2 FROM reviews WHERE ReviewDate >= DATE '2024-01-31' - 21"
    " AND RefreshDate <= DATE '2024-01-31' - 4 AND SensitiveTopic = 'Yes' AND " + _ONLINE +
    " UNION ALL SELECT * FROM (SELECT *, 3 FROM reviews ORDER BY RefreshDate ASC NULLS FIRST, ID LIMIT 20)))"
    " WHERE rn = 1)")
_ADIN = _inner_sql("_html", AD_DIV, "div")
_ART = _inner_sql("_html", ARTICLE, "article")
_ADIN_ART = _inner_sql(_ART, AD_DIV, "div")
_PARSE_OK = f"(CASE lower(Portal) WHEN 'indeed' THEN {_ART} IS NOT NULL WHEN 'glassdoor' THEN false ELSE true END)"
_FOUND = f"(CASE lower(Portal) WHEN 'indeed' THEN {_ADIN_ART} IS NOT NULL ELSE {_ADIN} IS NOT NULL END)"
_TEXT = f"(CASE lower(Portal) WHEN 'indeed' THEN {_html_text_sql(_ADIN_ART)} ELSE {_html_text_sql(_ADIN)} END)"
_OK2 = "(_status BETWEEN 200 AND 299)"
_SEEN = f"({_OK2} AND coalesce({_PARSE_OK}, false))"
_POSTED = f"({_SEEN} AND coalesce({_FOUND}, false))"
_WITH_TEXT = f"({_POSTED} AND {_TEXT} IS NOT NULL)"
_REFRESH_OUT = {
    "OnlineYesNo": f"CASE WHEN _status = 404 THEN 'No' WHEN {_OK2} THEN 'Yes' ELSE OnlineYesNo END",
    "RefreshDate": f"CASE WHEN _status = 404 OR {_OK2} THEN DATE '2024-01-31' ELSE RefreshDate END",
    "ResponsePostedYesNo": f"CASE WHEN {_POSTED} THEN 'Yes' WHEN {_SEEN} THEN 'No' ELSE ResponsePostedYesNo END",
    "Response": f"CASE WHEN {_WITH_TEXT} THEN {_TEXT} ELSE Response END",
    "ApprovalStatus": f"CASE WHEN {_WITH_TEXT} THEN 'Approved' ELSE ApprovalStatus END",
}


@register("apply_refresh", with_reviews(
    f"SELECT {G.row_select(_REFRESH_OUT)} FROM wl LEFT JOIN term USING (ID)", _FETCH, _TERM, _WL))
def q_apply_refresh(spark, sf):
    wl = W.refresh_worklist_distinct(reviews(spark, sf), FIXTURE_ASOF).drop("bucket")
    return R.apply_refresh(wl, page_fetches(spark, sf), FIXTURE_ASOF, FIXTURE_PAGES)


@register("response_days", with_reviews(
    "SELECT ID, CAST(datediff('day', ReviewDate, DATE '2024-01-31') AS INTEGER) AS response_days FROM reviews"))
def q_response_days(spark, sf):
    return reviews(spark, sf).select("ID", F.datediff(F.lit(FIXTURE_ASOF), F.col("ReviewDate"))
                                     .alias("response_days"))


@register("date_offsets", with_reviews(
    "SELECT ID, CAST(ReviewDate + 14 AS DATE) AS new_refresh_due,"
    " CAST(ReviewDate + 21 AS DATE) AS sensitive_until,"
    " CAST(RefreshDate + 4 AS DATE) AS next_sensitive_refresh FROM reviews"))
def q_date_offsets(spark, sf):
    r = reviews(spark, sf)
    return r.select("ID", F.date_add("ReviewDate", 14).alias("new_refresh_due"),
                    F.date_add("ReviewDate", 21).alias("sensitive_until"),
                    F.date_add("RefreshDate", 4).alias("next_sensitive_refresh"))


@register("is_blank", with_reviews(
    "SELECT ID, (Response = '' OR Response IS NULL) AS reply_blank,"
    f" coalesce(upper(Language) IN {tuple(CORE_LANGUAGES)}, false) AS core_language,"
    " lower(Portal) AS portal_key, TRY_CAST(CAST(OverallSatisfaction AS VARCHAR) AS DOUBLE) AS rating,"
    " TRY_CAST(JobTitle AS DOUBLE) AS job_number FROM reviews"))
def q_is_blank(spark, sf):
    r = reviews(spark, sf)
    return r.select("ID", blank_or_null(F.col("Response")).alias("reply_blank"),
                    F.coalesce(F.upper("Language").isin(CORE_LANGUAGES), F.lit(False)).alias("core_language"),
                    F.lower("Portal").alias("portal_key"),
                    F.col("OverallSatisfaction").cast("string").try_cast("double").alias("rating"),
                    F.col("JobTitle").try_cast("double").alias("job_number"))


USAGE_START = _dt.datetime(2024, 1, 5)
USAGE_END = _dt.datetime(2024, 1, 20)


@register("usage_report_scan", with_reviews(
    "SELECT event_id, ts, user_id, event_type, value FROM events"
    " WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'"))
def q_usage_report_scan(spark, sf):
    """The events landed as a compressed report, then read by the report reader."""
    path = scratch_path(spark, "usage", uuid.uuid4().hex)
    load(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value").write.option(
        "compression", "gzip").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return usage.usage_window(usage.usage_report_scan(spark, path), USAGE_START, USAGE_END)


@register("width_violations", with_feed(
    " UNION ALL ".join(
        f"SELECT ID, '{c}' AS \"column\", {w} AS width, CAST(length({c}) AS INTEGER) AS length FROM t"
        f" WHERE length({c}) > {w}" for c, w in WIDTHS.items()),
    f"t AS (SELECT {table_select(_INDEED)} FROM feed WHERE lower(portal) = 'indeed'"
    f" UNION ALL SELECT {table_select(_GLASSDOOR)} FROM feed WHERE lower(portal) = 'glassdoor'"
    f" UNION ALL SELECT {table_select(_KUNUNU)} FROM feed WHERE lower(portal) = 'kununu')"))
def q_width_violations(spark, sf):
    return A.width_violations(I.normalize(feed_scan(feed_pages(spark, sf)), FIXTURE_ASOF))
