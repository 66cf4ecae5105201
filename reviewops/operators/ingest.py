"""Feed rows -> canonical review rows.

Input: landed pages (``extract_landed``), or one row per review as produced by
``sources.feed.feed_scan`` (or any frame with the same field names): ``run_id,
portal, lang, page, pos, raw`` plus the typed review fields.  Every feed run is
cut on its own, so runs landed together do not end each other.  Steps, in the
order the extract applies them:

1. ``portal_guard``      - unknown portal (case-insensitive) -> rejected rows
2. ``drop_pinned_first`` - first-portal pages: position 0 older than asof-7d
3. ``feed_prefix``       - take-while: stop at the first review older than
   ``since`` (whole feed for portals 1 and 3, per page for portal 2)
4. ``normalize``         - one ``select`` per portal into the table schema
5. ``dedupe_incoming``   - first occurrence per ID (``operators.merge``) in feed
   order: run, portal, language as fetched, page, position
"""

from __future__ import annotations

import datetime as _dt

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..sources.feed import PAGE_KEYS, page_scan, typed_reviews
from ..functions import text as TX
from ..functions import htmlparse as HP
from ..functions.html import Selector
from .merge import dedupe_incoming

VALID = ["indeed", "glassdoor", "kununu"]
# Take-while scope per portal: the whole feed, or one page (per language).
PREFIX_SCOPE = {"indeed": "feed", "glassdoor": "page", "kununu": "feed"}
# The order in which a run fetches the languages of portal 2.
LANGUAGE_ORDER = ["de", "en", "nl", "it", "es", "fr", "pt"]
FEED_KEYS = ["run_id", "portal", "lang"]


def _c(n: str) -> Column:
    return F.col(n)


def _p() -> Column:
    return F.lower(_c("portal"))


def portal_guard(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a reason)."""
    ok = _p().isin(VALID)
    rejected = feed.filter(~ok | _c("portal").isNull()).select(
        "portal", "page", "pos", "id",
        F.concat(F.lit('"'), F.coalesce(_c("portal"), F.lit("")),
                 F.lit('" is not a supported portal')).alias("reason"))
    return feed.filter(ok), rejected


def feed_ts(feed: DataFrame) -> DataFrame:
    return feed.withColumn("ts", TX.parse_feed_ts(_c("datetime")))


def drop_pinned_first(feed: DataFrame, asof: _dt.date,
                      max_age_days: int = S.PINNED_REVIEW_MAX_AGE_DAYS) -> DataFrame:
    """On every first-portal page drop position 0 when it is older than
    ``asof - 7 days`` (a pinned top review).  Needs column ``ts``."""
    limit = TX.ts_literal(_dt.datetime.combine(asof, _dt.time()) - _dt.timedelta(days=max_age_days))
    pinned = (_p() == "indeed") & (_c("pos") == 0) & (_c("ts") < limit)
    return feed.filter(~F.coalesce(pinned, F.lit(False)))


def feed_prefix(feed: DataFrame, since: _dt.datetime, scope: str) -> DataFrame:
    """Take-while in feed order ``(page, pos)``: keep reviews before the first
    one older than ``since`` within each scope of one run.

    ``scope='feed'``: one cut per (run, portal, lang).  ``scope='page'``: one cut
    per landed page.  Cuts come from a partial aggregate; their join is plain,
    so AQE broadcasts them only where their measured size allows it and splits
    a feed that holds a large share of the rows.  Needs column ``ts``; an
    unparsable timestamp is not "old" (the reference would have failed on it).
    The extract itself works on whole pages (``page_window``).
    """
    keys = FEED_KEYS + (["page"] if scope == "page" else [])
    seq = F.struct(_c("page"), _c("pos"))
    old = _c("ts") < TX.ts_literal(since)
    cuts = feed.filter(old).groupBy(*keys).agg(F.min(seq).alias("_cut"))
    joined = feed.join(cuts, keys, "left")
    return joined.filter(_c("_cut").isNull() | (seq < _c("_cut"))).drop("_cut")


def page_window(landed: DataFrame, since: _dt.datetime, asof: _dt.date) -> DataFrame:
    """Per landed page of a supported portal: ``items`` (pos, raw) after the
    pinned drop and up to the page's first old review, and ``cut``, that
    review's position.  Row-local: nothing is exploded or shuffled."""
    limit = TX.ts_literal(_dt.datetime.combine(asof, _dt.time())
                          - _dt.timedelta(days=S.PINNED_REVIEW_MAX_AGE_DAYS))
    pages = page_scan(landed).filter(_p().isin(VALID)).select(*PAGE_KEYS, F.transform(
        "reviews", lambda raw, pos: F.struct(
            pos.alias("pos"), raw.alias("raw"),
            TX.parse_feed_ts(F.get_json_object(raw, "$.datetime")).alias("ts"))).alias("items"))
    pinned = lambda x: F.coalesce(
        (_p() == "indeed") & (x["pos"] == 0) & (x["ts"] < limit), F.lit(False))
    pages = pages.withColumn("items", F.filter("items", lambda x: ~pinned(x)))
    pages = pages.withColumn("cut", F.array_min(F.transform(
        F.filter("items", lambda x: x["ts"] < TX.ts_literal(since)), lambda x: x["pos"])))
    return pages.withColumn("items", F.filter(
        "items", lambda x: F.col("cut").isNull() | (x["pos"] < F.col("cut"))))


def feed_cuts(pages: DataFrame) -> DataFrame:
    """``run_id, portal, lang, cut_page``: the first page of each run's feed with
    an old review, for portals that stop there (one row per feed at most)."""
    return (pages.filter((_p() != "glassdoor") & _c("cut").isNotNull())
            .groupBy(*FEED_KEYS).agg(F.min("page").alias("cut_page")))


def rows_before_cuts(pages: DataFrame, cuts: DataFrame) -> DataFrame:
    """Feed rows of ``page_window`` pages up to their feed's cut: pages after the
    cut page go, the cut page itself already ends at its old review."""
    return page_rows(pages.join(cuts, FEED_KEYS, "left")
                     .filter(_c("cut_page").isNull() | (_c("page") <= _c("cut_page"))))


def page_rows(pages: DataFrame) -> DataFrame:
    """Feed rows of ``page_window`` pages."""
    return typed_reviews(pages.select(*PAGE_KEYS, F.explode("items").alias("i"))
                         .select(*PAGE_KEYS, "i.pos", "i.raw"))


def extract_window(feed: DataFrame, since: _dt.datetime, asof: _dt.date) -> DataFrame:
    """Guard, pinned drop and take-while per portal rule; returns feed rows."""
    valid, _ = portal_guard(feed)
    f = drop_pinned_first(feed_ts(valid), asof)
    by_page = feed_prefix(f.filter(_p() == "glassdoor"), since, "page")
    by_feed = feed_prefix(f.filter(_p() != "glassdoor"), since, "feed")
    return by_feed.unionByName(by_page)


def _common(portal: str, asof: _dt.date) -> dict[str, Column]:
    return {
        "Portal": F.lit(portal),
        "ID": _c("id"),
        "Link": _c("url"),
        "ReviewTitle": _c("title"),
        "ReviewDate": TX.parse_feed_ts(_c("datetime")).cast("date"),
        "RefreshDate": F.lit(asof),
        "OnlineYesNo": F.lit("Yes"),
        "OverallSatisfaction": TX.try_double(_c("rating")),
        "ResponsePostedYesNo": F.lit("No"),
    }


def _to_table(feed: DataFrame, cols: dict[str, Column], keep: tuple[str, ...]) -> DataFrame:
    """Table schema (missing columns as typed NULLs), then any ``keep`` columns."""
    table_cols = [cols.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                  for f in S.REVIEW_SCHEMA.fields]
    return feed.select(*table_cols, *keep)


def _indeed_cols(asof: _dt.date) -> dict[str, Column]:
    cols = _common("Indeed", asof)
    cols.update({
        "JobTitle": _c("reviewer"),
        "CurrentFormerEmployee": TX.first_word(_c("reviewer_employee_type")),
        "Location": _c("location"),
        "ReviewText": TX.compose_indeed_text(_c("pros"), _c("cons"), _c("text")),
    })
    return cols


def _glassdoor_cols(asof: _dt.date) -> dict[str, Column]:
    cols = _common("Glassdoor", asof)
    cols.update({
        "JobTitle": _c("reviewer"),
        "CurrentFormerEmployee": TX.current_former_from_flag(_c("is_current_job")),
        "Location": _c("location"),
        "ReviewText": TX.compose_glassdoor_text(_c("pros"), _c("cons")),
    })
    return cols


def _kununu_cols(asof: _dt.date) -> dict[str, Column]:
    reply = _c("reply.text")
    has_reply = TX.nonblank(reply)
    cols = _common("kununu", asof)
    cols.update({
        "Location": _c("company.city"),
        "ReviewText": TX.compose_kununu_text(_c("raw"), _c("text")),
        "Response": reply,
        "ResponsePostedYesNo": F.when(has_reply, F.lit("Yes")).otherwise(F.lit("No")),
        "ApprovalStatus": F.when(has_reply, F.lit("Approved")),
    })
    return cols


PORTAL_COLUMNS = {"indeed": _indeed_cols, "glassdoor": _glassdoor_cols, "kununu": _kununu_cols}


def normalize_indeed(feed: DataFrame, asof: _dt.date, keep: tuple[str, ...] = ()) -> DataFrame:
    return _to_table(feed.filter(_p() == "indeed"), _indeed_cols(asof), keep)


def normalize_glassdoor(feed: DataFrame, asof: _dt.date, keep: tuple[str, ...] = ()) -> DataFrame:
    return _to_table(feed.filter(_p() == "glassdoor"), _glassdoor_cols(asof), keep)


def normalize_kununu(feed: DataFrame, asof: _dt.date, keep: tuple[str, ...] = ()) -> DataFrame:
    return _to_table(feed.filter(_p() == "kununu"), _kununu_cols(asof), keep)


def normalize(feed: DataFrame, asof: _dt.date, keep: tuple[str, ...] = ()) -> DataFrame:
    """All portals in one pass: one ``CASE lower(portal)`` per column (no
    union of per-portal branches, so the feed is read and windowed once)."""
    per = {p: fn(asof) for p, fn in PORTAL_COLUMNS.items()}
    cols = {}
    for f in S.REVIEW_SCHEMA.fields:
        expr = None
        for p, pc in per.items():
            val = pc.get(f.name, F.lit(None)).cast(f.dataType)
            expr = F.when(_p() == p, val) if expr is None else expr.when(_p() == p, val)
        cols[f.name] = expr
    return _to_table(feed.filter(_p().isin(VALID)), cols, keep)


def in_feed_order(window: DataFrame, asof: _dt.date) -> DataFrame:
    """Table rows of the windowed feed rows with ``_ord``, their place in the order in
    which runs fetch: run, portal, language, page, position."""
    lang = F.array_position(F.array(*[F.lit(x) for x in LANGUAGE_ORDER]), F.lower("lang"))
    order = F.struct(_c("run_id"), _p().alias("portal"),
                     F.coalesce(F.nullif(lang, F.lit(0)), F.lit(len(LANGUAGE_ORDER) + 1)).alias("nth"),
                     _c("lang"), _c("page"), _c("pos"), _c("raw"))
    return normalize(window.withColumn("_ord", order), asof, keep=("_ord",))


def first_in_feed_order(window: DataFrame, asof: _dt.date) -> DataFrame:
    """Table rows of the windowed feed rows, the first occurrence per ID in feed order."""
    return dedupe_incoming(in_feed_order(window, asof), "_ord")


def extract_landed(landed: DataFrame, since: _dt.datetime, asof: _dt.date) -> DataFrame:
    """The whole extract from landed pages: the take-while is row-local on each
    page, and only one cut page per run and feed is joined back."""
    pages = page_window(landed, since, asof)
    return first_in_feed_order(rows_before_cuts(pages, feed_cuts(pages)), asof)


def extract_new_reviews(feed: DataFrame, since: _dt.datetime, asof: _dt.date) -> DataFrame:
    """The same extract from feed rows: guard -> pinned -> take-while ->
    normalize -> first occurrence per ID."""
    return first_in_feed_order(extract_window(feed, since, asof), asof)


# ---------------------------------------------------------------------------
# Employment block of a kununu review page (job title, former flag,
# department, contract end year).

def employment_parser(sel: Selector):
    """Arrow-batched exact lookup of the employment block and its bold and
    span parts (nested markup): ``ok, title, dept``."""
    spec = HP.selector_spec(sel)

    @F.pandas_udf("ok boolean, title string, dept string")
    def parse_blocks(html: pd.Series) -> pd.DataFrame:
        ok, title, dept = [], [], []
        for h in html:
            block = HP.find(HP.parse(h), *spec) if h is not None else None
            b = HP.find(block, "b", None, None) if block is not None else None
            s = HP.find(block, "span", None, None) if block is not None else None
            good = b is not None and s is not None
            ok.append(good)
            title.append(HP.text(b) if good else None)
            dept.append(HP.text(s) if good else None)
        return pd.DataFrame({"ok": ok, "title": title, "dept": dept})

    return parse_blocks


def employment_block(html: Column, sel: Selector) -> dict[str, Column]:
    """Columns set from the block; all NULL unless the block, its bold part
    and its span all exist.  Department = text between ``im Bereich `` and
    `` bei``; contract year = first `` 2ddd `` in the span."""
    parsed = employment_parser(sel)(html)
    ok, title, dept_text = parsed["ok"], parsed["title"], parsed["dept"]
    department = F.when(dept_text.contains("im Bereich"), F.split_part(
        F.split_part(dept_text, F.lit("im Bereich "), F.lit(2)), F.lit(" bei"), F.lit(1)))
    year = F.regexp_extract(dept_text, r" (2[0-9]{3}) ", 1)
    return {
        "JobTitle": F.when(ok, title),
        "CurrentFormerEmployee": F.when(ok, TX.current_former_from_title(title)),
        "Department": F.when(ok, department),
        "ContractTerminationKununuOnly": F.when(ok, F.nullif(year, F.lit("")).try_cast("int")),
    }


def supplement_kununu(table: DataFrame, fetched: DataFrame, sel: Selector) -> DataFrame:
    """Apply employment blocks (``fetched``: ``ID, html``) to kununu rows; a row
    without a usable block keeps its values."""
    cols = employment_block(F.col("_html"), sel)
    j = table.join(fetched.select("ID", F.col("html").alias("_html")), "ID", "left")
    out = []
    for name in table.columns:
        if name in cols:
            out.append(F.coalesce(cols[name], F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return j.select(*out)

