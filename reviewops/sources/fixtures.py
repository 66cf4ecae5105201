"""Derived test inputs built from the driver tables.

The driver ships no review data, so the canonical review table is derived from
``documents`` (text, language, source), ``labels`` (toxic flag), ``pages`` (link),
``conversations`` (first assistant turn = a posted reply) and ``nation`` (place).
Every derived input here is a pure function of those tables, so its size grows
with the scale factor.  ``plans`` holds the DuckDB twin of each derivation.

All joins are keyed by ``doc_id`` so the big side (documents, which carries the
text) is hash-partitioned once; the conversation reply is fanned out to the ten
documents it serves instead of joining on ``doc_id div 10`` (which would need a
second shuffle of the text).  Hints keep these joins the same at every size: what they
shuffle grows with the tables, and no growing table is broadcast.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import COLUMNS, FIXTURE_ASOF, REVIEW_SCHEMA
from ..session import ensure_parallelism
from .materialize import materialize_path, materialized
from .tables import load

NL = "\n"
# Stands for a raw line end while a page is built (JSON writes it as an escape).
RAW_MARK = "\u0001"


def _c(name: str) -> Column:
    return F.col(name)


def assistant_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First assistant turn per conversation (``min_by`` = partial aggregation)."""
    conv = load(spark, sf_dir, "conversations")
    return (conv.filter(_c("role") == "assistant")
            .groupBy("conv_id")
            .agg(F.min_by("text", "turn").alias("reply")))


def review_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = load(spark, sf_dir, "labels").select("doc_id", "toxic")
    pages = load(spark, sf_dir, "pages").select(_c("page_id").alias("doc_id"), "url")
    reply = assistant_replies(spark, sf_dir).select(
        F.explode(F.sequence(_c("conv_id") * 10, _c("conv_id") * 10 + 9)).alias("doc_id"),
        "reply")
    # nation is the fixed 25-row place dimension: size bound known, broadcast.
    nation = F.broadcast(load(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    return (docs.join(labels.hint("merge"), "doc_id", "left")
            .join(pages.hint("merge"), "doc_id", "left")
            .join(reply.hint("merge"), "doc_id", "left")
            .join(nation, (_c("doc_id") % 25) == _c("n_nationkey"), "left")
            .drop("n_nationkey"))


def portal_of(doc: Column) -> Column:
    return (F.when(doc % 3 == 0, "Indeed").when(doc % 3 == 1, "Glassdoor").otherwise("kununu"))


def review_date_of(doc: Column, asof: _dt.date) -> Column:
    return F.date_sub(F.lit(asof), ((doc * 7) % 45).cast("int"))


BASE_TABLES = ("documents", "labels", "pages", "conversations", "nation")


def reviews(spark: SparkSession, sf_dir: str, asof: _dt.date = FIXTURE_ASOF) -> DataFrame:
    """The review table for ``sf_dir``: derived once, stored as Parquet under
    the checkpoint folder, read like the production table."""
    if asof != FIXTURE_ASOF:
        return derive_reviews(spark, sf_dir, asof)
    return materialized(spark, sf_dir, "reviews", BASE_TABLES, derive_reviews, REVIEW_SCHEMA)


def derive_reviews(spark: SparkSession, sf_dir: str, asof: _dt.date = FIXTURE_ASOF) -> DataFrame:
    """The canonical 35-column review table derived from the driver tables."""
    b = review_base(spark, sf_dir)
    doc = _c("doc_id")
    portal = portal_of(doc)
    rdate = review_date_of(doc, asof)
    reply = _c("reply")
    text = _c("text")
    kununu_body = F.when(doc % 12 == 2, F.lit("")).otherwise(text)
    derived = {
        "Portal": portal,
        "ID": F.concat(F.lower(portal), F.lit("-"), doc.cast("string")),
        "Link": _c("url"),
        "ReviewTitle": F.concat(F.lit("Review "), doc.cast("string"), F.lit(" by "), _c("source")),
        "RefreshDate": F.when(doc % 17 == 0, F.lit(None)).otherwise(
            F.date_add(rdate, (doc % 5).cast("int"))),
        "ReviewDate": rdate,
        "OnlineYesNo": F.when(doc % 7 == 0, "No").when(doc % 7 == 1, F.lit(None)).otherwise("Yes"),
        "OverallSatisfaction": (1 + doc % 5).cast("double"),
        "JobTitle": _c("source"),
        "Location": F.when(doc % 6 == 0, F.lit(None)).otherwise(_c("n_name")),
        "Language": F.when(doc % 4 == 0, F.lit(None)).when(doc % 11 == 0, "PL")
                     .otherwise(F.upper(_c("lang"))),
        "ReviewText": F.when(portal == "Indeed", F.concat(
                          F.lit("Pros: "), _c("source"), F.lit(NL + NL + "Cons: "), _c("lang"),
                          F.lit(NL + NL), text))
                       .when(portal == "kununu", F.concat(
                          kununu_body, F.lit(NL + NL + "atmosphere rating: "),
                          (1 + doc % 5).cast("string"), F.lit("/5 " + NL + "salary rating: "),
                          (1 + doc % 4).cast("string"), F.lit("/5 ")))
                       .otherwise(text),
        "ReviewTextEN": F.when(doc % 2 == 0, text),
        "SensitiveTopic": F.when(_c("toxic") == 1, "Yes").when(_c("toxic") == 0, "No"),
        "ApprovalStatus": F.when(doc % 13 == 0, "Regenerate")
                           .when((doc % 5 < 2) | reply.isNull(), F.lit(None))
                           .when(doc % 3 == 0, "Pending")
                           .when(doc % 4 == 1, "ApplyNewResponse")
                           .otherwise("Approved"),
        "ResponsePostedYesNo": F.when((doc % 5 >= 2) & reply.isNotNull() & (doc % 2 == 0), "Yes")
                                .otherwise("No"),
        "Response": F.when(doc % 5 == 0, F.lit(None)).when(doc % 5 == 1, F.lit("")).otherwise(reply),
        "ResponseEN": F.when((doc % 3 == 1) & (doc % 5 >= 2), reply),
    }
    cols = [derived.get(name, F.lit(None)).cast(dtype).alias(name) for name, dtype, _ in COLUMNS]
    return b.select(*cols)


# --------------------------------------------------------------------------
# Merge fixtures: the stored table holds reviews up to a cut date, the
# incoming batch is the recent window, re-scored (overlap = updates).
MERGE_TARGET_BEFORE = _dt.date(2024, 1, 22)   # target: ReviewDate <  cut
MERGE_INCOMING_FROM = _dt.date(2024, 1, 8)    # incoming: ReviewDate >= from


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews(spark, sf_dir).filter(_c("ReviewDate") < F.lit(MERGE_TARGET_BEFORE))


def merge_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reviews(spark, sf_dir).filter(_c("ReviewDate") >= F.lit(MERGE_INCOMING_FROM))
    return r.withColumn("OverallSatisfaction", _c("OverallSatisfaction") + 10)


# --------------------------------------------------------------------------
# Feed fixture: one review per document, as the feed service would send it.
# Within a portal, review k = doc_id div 3 sits on the (k div 20)-th landed page
# at position k % 20; landed pages alternate between two runs.  Glassdoor pages
# are per language.  ``feed_flat`` is the typed form, ``feed_pages`` the landed
# JSON pages built from it.

def feed_flat(spark: SparkSession, sf_dir: str, asof: _dt.date = FIXTURE_ASOF) -> DataFrame:
    b = review_base(spark, sf_dir)
    doc = _c("doc_id")
    text = _c("text")
    k = F.floor(doc / 3)
    rdate = review_date_of(doc, asof)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    ts = F.concat(rdate.cast("string"), F.lit("T"), two(doc % 24), F.lit(":"), two(doc % 60),
                  F.lit(":"), two((doc * 7) % 60),
                  F.when(doc % 2 == 0, F.concat(F.lit("."), (doc % 1000).cast("string")))
                  .otherwise(F.lit("")))
    portal = (F.when(doc % 50 == 7, "xing").when(doc % 3 == 0, "indeed")
              .when(doc % 3 == 1, "Glassdoor").otherwise("KUNUNU"))
    rating_text = lambda c: (F.when(doc % 4 == 0, F.lit(""))
                             .when(doc % 4 == 1, F.lit(None)).otherwise(c))
    landed_page = F.floor(k / 20)
    return b.select(
        doc.alias("doc_id"),
        F.when(landed_page % 2 == 0, "run-1").otherwise("run-2").alias("run_id"),
        portal.alias("portal"),
        F.when(F.lower(portal) == "glassdoor", _c("lang")).otherwise(F.lit("all")).alias("lang"),
        F.floor(landed_page / 2).alias("page"),
        (k % 20).cast("int").alias("pos"),
        doc.cast("string").alias("id"),
        _c("url"),
        F.concat(_c("source"), F.lit(" "), _c("lang")).alias("title"),
        F.when(doc % 97 == 5, F.lit("n/a")).otherwise(ts).alias("datetime"),
        (1 + doc % 5).cast("string").alias("rating"),
        F.when(doc % 12 == 2, F.lit("")).otherwise(text).alias("text"),
        _c("source").alias("reviewer"),
        F.when(doc % 2 == 0, F.lit("Current Employee")).otherwise(F.lit("Former Employee"))
        .alias("reviewer_employee_type"),
        _c("n_name").alias("location"),
        F.when(doc % 4 < 2, _c("url")).alias("pros"),
        F.when(doc % 8 < 4, _c("lang")).alias("cons"),
        F.when(doc % 10 == 9, F.lit(None).cast("boolean")).otherwise(doc % 2 == 0)
        .alias("is_current_job"),
        _c("n_name").alias("company_city"),
        F.when(doc % 5 >= 2, _c("reply")).when(doc % 5 == 1, F.lit("")).alias("reply_text"),
        (1 + doc % 4).alias("salary_rating"),
        rating_text(_c("source")).alias("salary_text"),
        (1 + doc % 5).alias("work_life_rating"),
        rating_text(_c("lang")).alias("work_life_text"),
    )


def feed_pages(spark: SparkSession, sf_dir: str, asof: _dt.date = FIXTURE_ASOF) -> DataFrame:
    """Landed pages for ``sf_dir``, written once as JSON lines (the landing
    format) and read back through the landed-page schema."""
    from .feed import LANDED_SCHEMA

    if asof != FIXTURE_ASOF:
        return derive_feed_pages(spark, sf_dir, asof)
    return materialized(spark, sf_dir, "landed", BASE_TABLES, derive_feed_pages, LANDED_SCHEMA,
                        fmt="json")


def landed_dir(spark: SparkSession, sf_dir: str) -> str:
    """Folder of landed JSON-lines pages for ``sf_dir`` (the streaming source)."""
    return materialize_path(spark, sf_dir, "landed", BASE_TABLES, derive_feed_pages, fmt="json")


def derive_feed_pages(spark: SparkSession, sf_dir: str, asof: _dt.date = FIXTURE_ASOF) -> DataFrame:
    """Landed pages (``run_id, portal, lang, page, body``) built from
    ``feed_flat``.  Reviews are joined with a raw line feed between them, as a
    pretty-printed service response would be, and every fifth review has raw
    CR LF inside its text: without cleaning such a body is no JSON."""
    f = feed_flat(spark, sf_dir, asof)
    c = _c
    is_kununu = F.lower(c("portal")) == "kununu"
    review = F.struct(
        c("id"), c("url"), c("title"), c("datetime"), c("rating").cast("int").alias("rating"),
        F.when(c("doc_id") % 5 == 1, F.replace(c("text"), F.lit(NL), F.lit(RAW_MARK)))
        .otherwise(c("text")).alias("text"), c("reviewer"), c("reviewer_employee_type"), c("location"), c("pros"), c("cons"),
        c("is_current_job"),
        F.when(is_kununu, F.struct(c("company_city").alias("city"))).alias("company"),
        F.when(is_kununu, F.struct(c("reply_text").alias("text"))).alias("reply"),
        F.when(is_kununu, F.struct(c("salary_rating").alias("rating"),
                                   c("salary_text").alias("text"))).alias("salary_rating"),
        F.when(is_kununu, F.struct(c("work_life_rating").alias("rating"),
                                   c("work_life_text").alias("text"))).alias("work_life_rating"),
    )
    json = F.replace(F.to_json(review), F.lit("\\u0001"), F.lit("\r\n"))
    items = f.select("run_id", "portal", "lang", "page", F.struct(c("pos"), json.alias("j")).alias("it"))
    return (items.groupBy("run_id", "portal", "lang", "page")
            .agg(F.sort_array(F.collect_list("it")).alias("items"))
            .select("run_id", "portal", "lang", "page",
                    F.concat(F.lit('{"reviews": ['),
                             F.array_join(F.transform("items", lambda x: x["j"]), ",\n"),
                             F.lit("]}")).alias("body")))


# Fetched employment blocks for kununu reviews (page fetch per review).
EMPLOYMENT_CLASS = "employment-info"


FETCHED_PAGE_SCHEMA = T.StructType([T.StructField("ID", T.StringType()),
                                     T.StructField("html", T.StringType())])


def employment_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched kununu review pages (``ID, html``), stored once like a fetch
    ledger and read back."""
    return materialized(spark, sf_dir, "employment-pages", BASE_TABLES, derive_employment_pages,
                        FETCHED_PAGE_SCHEMA)


def derive_employment_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = feed_flat(spark, sf_dir).filter(F.lower(_c("portal")) == "kununu")
    doc = _c("doc_id")
    dept = F.concat(F.lit("Angestellte/r im Bereich "), F.initcap(_c("lang")), F.lit(" bei Firma"),
                    F.when(doc % 4 == 0, F.concat(F.lit(", bis "), (2015 + doc % 9).cast("string"),
                                                  F.lit(" "))).otherwise(F.lit("")))
    title = F.when(doc % 6 == 2, F.concat(F.lit("Ex-"), _c("reviewer"))).otherwise(_c("reviewer"))
    block = F.concat(F.lit(f'<div class="{EMPLOYMENT_CLASS}"><b>'), title, F.lit("</b>"),
                     F.when(doc % 9 == 1, F.lit("")).otherwise(
                         F.concat(F.lit("<span>"), dept, F.lit("</span>"))),
                     F.lit("</div>"))
    html = F.concat(F.lit("<html><body>"),
                    F.when(doc % 10 == 3, F.lit("")).otherwise(block), F.lit("</body></html>"))
    return f.select(_c("id").alias("ID"), html.alias("html"))


# --------------------------------------------------------------------------
# Model answers (ledger rows) derived per review.  Content is free text with
# one flat JSON object; key spellings vary, some answers have no object, some
# miss a key, some carry a non-numeric score or an off-list aspect.

def _arr(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _review_id(doc: Column) -> Column:
    return F.concat(F.lower(portal_of(doc)), F.lit("-"), doc.cast("string"))


def answer_content(doc: Column, text: Column, place: Column, toxic: Column) -> Column:
    from ..schema import NEGATIVE_ASPECTS, POSITIVE_ASPECTS

    q = lambda s: F.concat(F.lit('"'), s, F.lit('"'))
    rkey = F.when(doc % 3 == 0, "Response").when(doc % 3 == 1, "response").otherwise("RESPONSE")
    clean = F.replace(F.replace(F.replace(text, F.lit('"'), F.lit("")),
                                F.lit("\\"), F.lit("")), F.lit(NL), F.lit("\\n"))
    rval = F.when(doc % 29 == 0, F.lit("(Leer)")).when(doc % 31 == 0, F.lit("")).otherwise(clean)
    ckey = F.when(doc % 2 == 0, "Country").otherwise("country")
    pos = F.when(doc % 53 == 0, F.lit("Great pizza")).otherwise(
        F.element_at(_arr(POSITIVE_ASPECTS), (1 + doc % 18).cast("int")))
    neg = F.element_at(_arr(NEGATIVE_ASPECTS), (1 + (doc * 7) % 18).cast("int"))
    sens = F.when(toxic == 1, "Yes").otherwise("No")
    emp = F.when(doc % 23 == 0, F.lit('"n/a"')).otherwise((1 + doc % 5).cast("string"))
    hlp = F.when(doc % 37 == 0, F.lit("")).otherwise(
        F.concat(F.lit(', "HelpfulnessScore": '), (1 + doc % 4).cast("string")))
    ind = ((doc * 3) % 7).cast("string")
    obj = F.concat(
        F.lit("{"), q(rkey), F.lit(": "), q(rval),
        F.lit(', "StateRegion": '), q(F.concat(F.lit("Region "), (doc % 7).cast("string"))),
        F.lit(", "), q(ckey), F.lit(": "), q(F.coalesce(place, F.lit("?"))),
        F.lit(', "MainPositiveAspect": '), q(pos), F.lit(', "MainAreaOfImprovement": '), q(neg),
        F.lit(', "SensitiveTopic": '), q(sens), F.lit(', "EmpathyScore": '), emp, hlp,
        F.lit(', "IndividualityScore": '), ind, F.lit("}"))
    return F.when(doc % 19 == 0, F.lit("no object here")).otherwise(
        F.concat(F.lit("Sure: "), obj, F.lit(" bye")))


ANSWER_LEDGER_SCHEMA = "ID string, kind string, field string, attempt int, status int, content string"


def model_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answer ledger for ``sf_dir`` (derived once, stored as Parquet)."""
    from pyspark.sql.types import _parse_datatype_string

    return materialized(spark, sf_dir, "answers", BASE_TABLES, derive_model_answers,
                        _parse_datatype_string(ANSWER_LEDGER_SCHEMA))


def derive_model_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reply and completion answers, one attempt each, for every review."""
    b = review_base(spark, sf_dir)
    doc = _c("doc_id")
    status = F.when(doc % 41 == 0, 500).when(doc % 43 == 0, 429).otherwise(200)
    content = answer_content(doc, _c("text"), _c("n_name"), _c("toxic"))
    one = b.select(_review_id(doc).alias("ID"), F.lit(None).cast("string").alias("field"),
                   F.lit(1).alias("attempt"), status.alias("status"), content.alias("content"))
    return (one.withColumn("kind", F.lit("reply"))
            .unionByName(one.withColumn("kind", F.lit("completion")))
            .select("ID", "kind", "field", "attempt", "status", "content"))


# A verified English translation body used by the fixture.
EN_TRANSLATION = "This is the English text of the review and it is from the team"


def translation_answers(spark: SparkSession, sf_dir: str, requests: DataFrame) -> DataFrame:
    """Attempts per translation request: the untranslated source (or a failed
    call), then either an English text or still-foreign text; the latter is
    followed by two foreign answers or refused calls, then an English one, which
    is in time only where the calls were refused."""
    doc = F.split_part(_c("ID"), F.lit("-"), F.lit(2)).cast("long")
    a1 = requests.select("ID", "field",
                         F.lit(1).alias("attempt"),
                         F.when(doc % 11 == 5, 500).otherwise(200).alias("status"),
                         F.col("source").alias("content"))
    a2 = requests.select("ID", "field", F.lit(2).alias("attempt"), F.lit(200).alias("status"),
                         F.when(doc % 4 == 3, F.lit("le la les des du et une qui"))
                         .otherwise(F.lit(EN_TRANSLATION)).alias("content"))
    later = requests.filter(doc % 4 == 3).select(
        "ID", "field", F.explode(F.array(F.lit(3), F.lit(4), F.lit(5))).alias("attempt")).select(
        "ID", "field", "attempt",
        F.when((_c("attempt") < 5) & (doc % 8 == 3), 429).otherwise(200).alias("status"),
        F.when(_c("attempt") < 5, F.lit("le la les des du et une qui")).otherwise(F.lit(EN_TRANSLATION)).alias("content"))
    return a1.unionByName(a2).unionByName(later).withColumn("kind", F.lit("translation"))


def page_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch attempts keyed to review IDs: 404 when page_id % 9 = 0; a 500
    when page_id % 9 = 1, retried with success when page_id % 27 = 1."""
    pages = ensure_parallelism(load(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    pid = _c("page_id")
    rid = _review_id(pid).alias("ID")
    first = pages.select(rid, F.lit(1).alias("attempt"),
                         F.when(pid % 9 == 0, 404).when(pid % 9 == 1, 500).otherwise(200).alias("status"),
                         F.when(pid % 9 >= 2, _c("html")).alias("html"))
    retry = pages.filter(pid % 27 == 1).select(rid, F.lit(2).alias("attempt"),
                                               F.lit(200).alias("status"), _c("html"))
    return first.unionByName(retry)
