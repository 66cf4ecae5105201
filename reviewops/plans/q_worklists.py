"""Registered work-list queries (table scan, filters, top-n, refresh lists)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..operators import worklists as W
from ..schema import FIXTURE_ASOF
from ..sources.fixtures import reviews
from .oracle import COLS, with_reviews
from .registry import register
from .sqlgen import row_select

SINCE = _dt.date(2024, 1, 11)

ONLINE = "(OnlineYesNo IS NULL OR OnlineYesNo = 'Yes')"


@register("table_scan", with_reviews("SELECT * FROM reviews"))
def q_table_scan(spark, sf):
    return reviews(spark, sf)


@register("unanswered_since", with_reviews(
    "SELECT * FROM reviews WHERE ((Response = '' OR Response IS NULL) AND ReviewDate >= DATE '2024-01-11')"
    " OR ApprovalStatus = 'Regenerate'"))
def q_unanswered_since(spark, sf):
    return W.unanswered(reviews(spark, sf), since=SINCE)


@register("unanswered_all", with_reviews(
    "SELECT * FROM reviews WHERE (Response = '' OR Response IS NULL) OR ApprovalStatus = 'Regenerate'"))
def q_unanswered_all(spark, sf):
    return W.unanswered(reviews(spark, sf))


@register("incomplete_rows", with_reviews(
    "SELECT * FROM reviews WHERE NOT (Response = '' OR Response IS NULL) AND SensitiveTopic IS NULL"))
def q_incomplete_rows(spark, sf):
    return W.incomplete_rows(reviews(spark, sf))


@register("incomplete_rows_top", with_reviews(
    "SELECT * FROM reviews WHERE NOT (Response = '' OR Response IS NULL) AND SensitiveTopic IS NULL"
    " ORDER BY ID LIMIT 20"))
def q_incomplete_rows_top(spark, sf):
    return W.incomplete_rows(reviews(spark, sf), count=20)


@register("regenerate_rows", with_reviews(
    "SELECT * FROM reviews WHERE ApprovalStatus = 'Regenerate' ORDER BY ID LIMIT 10"))
def q_regenerate_rows(spark, sf):
    return W.regenerate_rows(reviews(spark, sf), count=10)


@register("limit_n", with_reviews(
    "SELECT 'all' AS pick, ID FROM reviews WHERE ApprovalStatus = 'Regenerate'"
    " UNION ALL SELECT 'three', ID FROM (SELECT ID FROM reviews WHERE ApprovalStatus = 'Regenerate' ORDER BY ID LIMIT 3)"))
def q_limit_n(spark, sf):
    """TOP n for n = none given (all rows), 0 (no row) and 3."""
    r = reviews(spark, sf)
    pick = lambda name, n: W.regenerate_rows(r, n).select(F.lit(name).alias("pick"), "ID")
    return pick("all", None).unionByName(pick("none", 0)).unionByName(pick("three", 3))


@register("refresh_new", with_reviews(
    f"SELECT * FROM reviews WHERE ReviewDate = DATE '2024-01-31' - 14 AND {ONLINE}"))
def q_refresh_new(spark, sf):
    return W.refresh_new(reviews(spark, sf), FIXTURE_ASOF)


@register("refresh_sensitive", with_reviews(
    "SELECT * FROM reviews WHERE ReviewDate >= DATE '2024-01-31' - 21"
    " AND RefreshDate <= DATE '2024-01-31' - 4 AND SensitiveTopic = 'Yes'"
    f" AND {ONLINE}"))
def q_refresh_sensitive(spark, sf):
    return W.refresh_sensitive(reviews(spark, sf), FIXTURE_ASOF)


@register("refresh_oldest_day", with_reviews(
    "SELECT * FROM reviews WHERE RefreshDate = (SELECT min(RefreshDate) FROM reviews)"
    f" AND {ONLINE}"))
def q_refresh_oldest_day(spark, sf):
    return W.refresh_oldest_day(reviews(spark, sf))


@register("min_refresh_date", with_reviews(
    "SELECT min(RefreshDate) AS min_refresh_date FROM reviews"))
def q_min_refresh_date(spark, sf):
    return W.min_refresh_date(reviews(spark, sf))


@register("refresh_oldest_n", with_reviews(
    "SELECT * FROM reviews ORDER BY RefreshDate ASC NULLS FIRST, ID LIMIT 20"))
def q_refresh_oldest_n(spark, sf):
    return W.refresh_oldest_n(reviews(spark, sf), 20)


@register("posting_queue", with_reviews(
    "SELECT ID, Link, Response FROM reviews WHERE ResponsePostedYesNo = 'No' AND OnlineYesNo = 'Yes'"
    " AND ApprovalStatus = 'Approved' OR ApprovalStatus = 'ApplyNewResponse'"))
def q_posting_queue(spark, sf):
    return W.posting_queue(reviews(spark, sf))


@register("queue_projection", with_reviews("SELECT ID, Link, Response FROM reviews"))
def q_queue_projection(spark, sf):
    return W.queue_projection(reviews(spark, sf))


_TRANSLATE = ("SELECT * FROM reviews WHERE (ReviewTextEN IS NULL OR ResponseEN IS NULL)"
              " AND Response IS NOT NULL")


@register("translate_candidates", with_reviews(_TRANSLATE))
def q_translate_candidates(spark, sf):
    return W.translate_candidates(reviews(spark, sf))


@register("top_translate", with_reviews(_TRANSLATE + " ORDER BY ReviewDate DESC, ID LIMIT 20"))
def q_top_translate(spark, sf):
    return W.translate_candidates(reviews(spark, sf), 20)


_REFRESH_PARTS = (
    f"SELECT {COLS}, 'new' AS bucket FROM reviews"
    f" WHERE ReviewDate = DATE '2024-01-31' - 14 AND {ONLINE}"
    f" UNION ALL SELECT {COLS}, 'sensitive' AS bucket FROM reviews"
    " WHERE ReviewDate >= DATE '2024-01-31' - 21 AND RefreshDate <= DATE '2024-01-31' - 4"
    f" AND SensitiveTopic = 'Yes' AND {ONLINE}"
    f" UNION ALL SELECT * FROM (SELECT {COLS}, 'oldest' AS bucket FROM reviews"
    " ORDER BY RefreshDate ASC NULLS FIRST, ID LIMIT 20)")


@register("refresh_worklist", with_reviews(_REFRESH_PARTS))
def q_refresh_worklist(spark, sf):
    return W.refresh_worklist(reviews(spark, sf), FIXTURE_ASOF)


@register("refresh_worklist_distinct", with_reviews(
    f"SELECT {COLS}, bucket FROM (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY"
    " CASE bucket WHEN 'new' THEN 1 WHEN 'sensitive' THEN 2 ELSE 3 END) AS rn"
    f" FROM ({_REFRESH_PARTS})) WHERE rn = 1"))
def q_refresh_worklist_distinct(spark, sf):
    return W.refresh_worklist_distinct(reviews(spark, sf), FIXTURE_ASOF)


_QUEUE = ("SELECT ID FROM reviews WHERE ResponsePostedYesNo = 'No' AND OnlineYesNo = 'Yes'"
          " AND ApprovalStatus = 'Approved' OR ApprovalStatus = 'ApplyNewResponse'")


@register("mark_posted", with_reviews(
    "SELECT " + row_select({"ResponsePostedYesNo": f"CASE WHEN ID IN ({_QUEUE}) THEN 'Yes'"
                                                   " ELSE ResponsePostedYesNo END"}) + " FROM reviews"))
def q_mark_posted(spark, sf):
    r = reviews(spark, sf)
    return W.mark_posted(r, W.posting_queue(r))
