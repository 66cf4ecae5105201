"""Registered enrichment queries: requests, answer application, re-aimed
set-based classifiers and rubric scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import answers as AN
from ..functions import text as TX
from ..operators import classify as C
from ..operators import enrich as E
from ..operators import worklists as W
from .. import schema as S
from ..schema import FIXTURE_ASOF
from ..sources.fixtures import model_answers, reviews, translation_answers
from ..sources.tables import load
from . import sqlgen as G
from .oracle import with_reviews
from .q_worklists import SINCE
from .registry import register

ASOF = "DATE '2024-01-31'"
# The ledger holds a reply and a completion answer for every review.
BOTH_KINDS = "both_kinds AS (SELECT * FROM answers, (VALUES ('reply'), ('completion')) AS k(kind))"
UNANSWERED = ("rows AS (SELECT * FROM reviews WHERE ((Response = '' OR Response IS NULL)"
              " AND ReviewDate >= DATE '2024-01-11') OR ApprovalStatus = 'Regenerate')")
JOINED = ("j AS (SELECT rows.*, a.status AS _status, "
          f"{G.answer_obj('a.content')} AS obj FROM rows LEFT JOIN answers a USING (ID))")


def _unanswered(spark, sf):
    return W.unanswered(reviews(spark, sf), since=SINCE)


# -- requests ----------------------------------------------------------------

_LANG_CONTENT = (f"'Title: ' || coalesce(ReviewTitle, '') || CASE WHEN {G.nonblank(G.strip_labels())}"
                 f" THEN {G.NL} || 'Text: ' || {G.strip_labels()} ELSE '' END"
                 f" || CASE WHEN {G.nonblank('Location')} THEN {G.NL} || '(Location: ' || Location || ')'"
                 " ELSE '' END")


@register("language_requests", with_reviews(
    f"SELECT ID, 'language' AS kind, {_LANG_CONTENT} AS content FROM reviews WHERE Language IS NULL"))
def q_language_requests(spark, sf):
    return E.language_requests(reviews(spark, sf)).select("ID", "kind", "content")


@register("strip_labels", with_reviews(f"SELECT ID, {G.strip_labels()} AS stripped FROM reviews"))
def q_strip_labels(spark, sf):
    r = reviews(spark, sf)
    return r.select("ID", TX.strip_labels(F.col("Portal"), F.col("ReviewText")).alias("stripped"))


def _f(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), 'None')"


_REPLY_CONTENT = (
    f"'Bewertungstitel: ' || {_f('ReviewTitle')} || {G.NL} || {G.NL} || {_f('ReviewText')}"
    f" || {G.NL} || {G.NL} || '(Bewertung insgesamt: ' || {_f('OverallSatisfaction')} || '/5.0)'"
    f" || CASE WHEN {G.nonblank('Location')} THEN {G.NL} || {G.NL} || '(Ort: ' || Location || ')' ELSE '' END"
    f" || {G.NL} || {G.NL} || '(Sprache: ' || {G.reply_language()} || ')'")


@register("reply_requests", with_reviews(
    f"SELECT ID, 'reply' AS kind, {G.reply_language()} AS reply_lang, {_REPLY_CONTENT} AS content,"
    " CAST(CASE WHEN ApprovalStatus = 'Regenerate' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS presence_penalty"
    " FROM rows WHERE Language IS NOT NULL", UNANSWERED))
def q_reply_requests(spark, sf):
    return E.reply_requests(_unanswered(spark, sf)).select(
        "ID", "kind", "reply_lang", "content", "presence_penalty")


@register("completion_requests", with_reviews(
    "SELECT ID, 'completion' AS kind, ReviewText || CASE WHEN "
    f"{G.nonblank('Location')} THEN {G.NL} || '(Ort: ' || Location || ')' ELSE '' END AS review_content,"
    " Response AS reply_content FROM reviews WHERE NOT (Response = '' OR Response IS NULL)"
    " AND SensitiveTopic IS NULL AND Response IS NOT NULL"))
def q_completion_requests(spark, sf):
    return E.completion_requests(W.incomplete_rows(reviews(spark, sf))).select(
        "ID", "kind", "review_content", "reply_content")


_TRANSLATE_ROWS = ("rows AS (SELECT * FROM reviews WHERE (ReviewTextEN IS NULL OR ResponseEN IS NULL)"
                   " AND Response IS NOT NULL)")
_TREQ = (
    "treq AS (SELECT ID, 'ReviewTextEN' AS field, ReviewText AS source FROM rows"
    f" WHERE (Language IS NULL OR Language <> 'EN') AND {G.blank('ReviewTextEN')}"
    f" AND {G.nonblank(G.strip_labels())}"
    " UNION ALL SELECT ID, 'ResponseEN' AS field, Response AS source FROM rows"
    f" WHERE (Language IS NULL OR Language <> 'EN') AND {G.blank('ResponseEN')}"
    f" AND {G.nonblank('Response')})")


@register("translation_requests", with_reviews(
    "SELECT ID, 'translation' AS kind, field, source FROM treq", _TRANSLATE_ROWS, _TREQ))
def q_translation_requests(spark, sf):
    rows = W.translate_candidates(reviews(spark, sf))
    return E.translation_requests(rows).select("ID", "kind", "field", "source")


# -- answers -------------------------------------------------------------------

@register("choice_content", with_reviews(
    "SELECT ID, kind, json_extract_string('{\"choices\":[{\"message\":' || json_object('content', content)"
    " || '}]}', '$.choices[0].message.content') AS content FROM both_kinds", G.ANSWERS_CTE, BOTH_KINDS))
def q_choice_content(spark, sf):
    a = model_answers(spark, sf)
    body = F.concat(F.lit('{"choices":[{"message":'), F.to_json(F.struct("content")), F.lit("}]}"))
    return a.select("ID", "kind", AN.choice_content(body).alias("content"))


@register("answer_object", with_reviews(
    f"SELECT ID, kind, obj IS NOT NULL AS parsed, {G.get('Response')} AS response,"
    f" {G.get('EmpathyScore')} AS empathy, CAST(len(json_keys(obj)) AS INTEGER) AS n_keys"
    f" FROM (SELECT ID, kind, {G.answer_obj('content')} AS obj FROM both_kinds)", G.ANSWERS_CTE, BOTH_KINDS))
def q_answer_object(spark, sf):
    a = model_answers(spark, sf)
    obj = AN.answer_object(F.col("content"))
    return a.select("ID", "kind", obj.isNotNull().alias("parsed"), AN.answer_get(obj, "Response").alias("response"),
                    AN.answer_get(obj, "EmpathyScore").alias("empathy"),
                    F.when(obj.isNotNull(), F.size(F.map_keys(obj))).alias("n_keys"))


@register("unescape_newline", with_reviews(
    f"SELECT ID, kind, replace({G.get('Response')}, '\\n', {G.NL}) AS response"
    f" FROM (SELECT ID, kind, {G.answer_obj('content')} AS obj FROM both_kinds)", G.ANSWERS_CTE, BOTH_KINDS))
def q_unescape_newline(spark, sf):
    a = model_answers(spark, sf)
    obj = AN.answer_object(F.col("content"))
    return a.select("ID", "kind", TX.unescape_newline(AN.answer_get(obj, "Response")).alias("response"))


@register("apply_reply", with_reviews(
    f"SELECT {G.row_select(G.reply_steps(ASOF))} FROM j", G.ANSWERS_CTE, UNANSWERED, JOINED))
def q_apply_reply(spark, sf):
    return E.apply_reply(_unanswered(spark, sf), model_answers(spark, sf), FIXTURE_ASOF)


_INCOMPLETE = ("rows AS (SELECT * FROM reviews WHERE NOT (Response = '' OR Response IS NULL)"
               " AND SensitiveTopic IS NULL)")


@register("apply_completion", with_reviews(
    f"SELECT {G.row_select(G.completion_steps())} FROM j", G.ANSWERS_CTE, _INCOMPLETE, JOINED))
def q_apply_completion(spark, sf):
    a = model_answers(spark, sf)
    return E.apply_completion(W.incomplete_rows(reviews(spark, sf)), a)


@register("request_errors", with_reviews(
    "SELECT ID, kind, status, CAST(status AS VARCHAR) AS DeveloperComment FROM"
    " (SELECT ID, 'reply' AS kind, status FROM answers UNION ALL SELECT ID, 'completion', status FROM answers)"
    " WHERE NOT (status BETWEEN 200 AND 299) AND ID IN (SELECT ID FROM reviews)", G.ANSWERS_CTE))
def q_request_errors(spark, sf):
    return E.request_errors(reviews(spark, sf), model_answers(spark, sf))


# translation ledger: attempts with the detected language of each answer
_TANS = (
    "tans AS (SELECT ID, field, attempt, status, content,"
    f" {G.language_of('content')} AS lang FROM ("
    " SELECT ID, field, 1 AS attempt,"
    " CASE WHEN CAST(split_part(ID, '-', 2) AS BIGINT) % 11 = 5 THEN 500 ELSE 200 END AS status,"
    " source AS content FROM treq"
    " UNION ALL SELECT ID, field, 2, 200, CASE WHEN CAST(split_part(ID, '-', 2) AS BIGINT) % 4 = 3"
    " THEN 'le la les des du et une qui' ELSE"
    " 'This is the English text of the review and it is from the team' END FROM treq"
    " UNION ALL SELECT ID, field, a, CASE WHEN a < 5 AND CAST(split_part(ID, '-', 2) AS BIGINT) % 8 = 3 THEN 429"
    " ELSE 200 END, CASE WHEN a < 5 THEN 'le la les des du et une qui' ELSE"
    " 'This is the English text of the review and it is from the team' END FROM treq, (VALUES (3), (4), (5)) AS v(a)"
    " WHERE CAST(split_part(ID, '-', 2) AS BIGINT) % 4 = 3))")
_TGOOD = ("tfirst AS (SELECT ID,"
          " arg_min(content, attempt) FILTER (WHERE field = 'ReviewTextEN') AS _rev,"
          " arg_min(content, attempt) FILTER (WHERE field = 'ResponseEN') AS _resp FROM (SELECT *,"
          " row_number() OVER (PARTITION BY ID, field ORDER BY attempt) AS nth FROM tans"
          " WHERE status BETWEEN 200 AND 299)"
          " WHERE lang = 'EN' AND nth <= 3 GROUP BY ID)")
_TERR = ("terr AS (SELECT ID, arg_max(status, attempt) AS _err FROM tans"
         " WHERE NOT (status BETWEEN 200 AND 299) GROUP BY ID)")
_TTRIED = ("ttried AS (SELECT ID, list(DISTINCT field) AS _fields FROM tans GROUP BY ID)")
_LABELS_ONLY = G.blank(G.strip_labels())
_IS_EN = "(Language = 'EN')"
_REV_NEEDED = f"(NOT coalesce({_IS_EN}, false) AND {G.blank('ReviewTextEN')} AND NOT {_LABELS_ONLY})"
_RESP_NEEDED = f"(NOT coalesce({_IS_EN}, false) AND {G.blank('ResponseEN')} AND {G.nonblank('Response')})"
_TRANSLATION_OUT = {
    "ReviewTextEN": (f"CASE WHEN {_IS_EN} THEN ReviewText WHEN NOT {G.blank('ReviewTextEN')} THEN ReviewTextEN"
                     f" WHEN {_LABELS_ONLY} THEN ReviewText ELSE coalesce(_rev, ReviewTextEN) END"),
    "ResponseEN": (f"CASE WHEN {_IS_EN} THEN Response WHEN NOT {G.blank('ResponseEN')} THEN ResponseEN"
                   " ELSE coalesce(_resp, ResponseEN) END"),
    "DeveloperComment": (
        f"CASE WHEN ({_REV_NEEDED} AND list_contains(coalesce(_fields, []), 'ReviewTextEN') AND _rev IS NULL)"
        f" OR ({_RESP_NEEDED} AND list_contains(coalesce(_fields, []), 'ResponseEN') AND _resp IS NULL)"
        " THEN 'Check lang'"
        f" WHEN _err IS NOT NULL AND NOT coalesce({_IS_EN}, false) THEN CAST(_err AS VARCHAR) || '(translation)'"
        " ELSE DeveloperComment END"),
}


@register("apply_translation", with_reviews(
    f"SELECT {G.row_select(_TRANSLATION_OUT)} FROM rows LEFT JOIN tfirst USING (ID)"
    " LEFT JOIN terr USING (ID) LEFT JOIN ttried USING (ID)",
    _TRANSLATE_ROWS, _TREQ, _TANS, _TGOOD, _TERR, _TTRIED))
def q_apply_translation(spark, sf):
    rows = W.translate_candidates(reviews(spark, sf))
    req = E.translation_requests(rows)
    ans = translation_answers(spark, sf, req).withColumn("lang", C.text_language(F.col("content")))
    return E.apply_translation(rows, ans)


# -- re-aimed classifiers ----------------------------------------------------

@register("detect_language", with_reviews(f"SELECT ID, {G.detect_language()} AS detected_lang FROM reviews"))
def q_detect_language(spark, sf):
    return C.detect_language(reviews(spark, sf)).select("ID", "detected_lang")


@register("fill_language", with_reviews(
    f"SELECT ID, coalesce(Language, upper({G.detect_language()})) AS Language FROM reviews"))
def q_fill_language(spark, sf):
    return C.fill_language(C.detect_language(reviews(spark, sf))).select("ID", "Language")


@register("reply_language", with_reviews(
    f"SELECT ID, Portal, Language, {G.reply_language()} AS reply_lang FROM reviews"))
def q_reply_language(spark, sf):
    r = reviews(spark, sf)
    return r.select("ID", "Portal", "Language",
                    C.reply_language(F.col("Language"), F.col("Portal")).alias("reply_lang"))


@register("geo_enrich", with_reviews(
    "SELECT r.ID, CASE WHEN coalesce(r.Location, '') <> '' AND p.place IS NOT NULL THEN p.sr"
    " ELSE r.StateRegion END AS StateRegion,"
    " CASE WHEN coalesce(r.Location, '') <> '' AND p.place IS NOT NULL THEN p.co ELSE r.Country END"
    " AS Country FROM reviews r LEFT JOIN (SELECT n_name AS place, r_name AS sr, n_name AS co"
    " FROM nation JOIN region ON n_regionkey = r_regionkey) p ON r.Location = p.place"))
def q_geo_enrich(spark, sf):
    places = C.places_from_nation(load(spark, sf, "nation"), load(spark, sf, "region"))
    return C.geo_enrich(reviews(spark, sf), places).select("ID", "StateRegion", "Country")


@register("classify_aspects", with_reviews(
    f"SELECT ID, {G.aspects('pos')} AS pos_aspect, {G.aspects('neg')} AS neg_aspect FROM reviews"))
def q_classify_aspects(spark, sf):
    return C.classify_aspects(reviews(spark, sf)).select("ID", "pos_aspect", "neg_aspect")


@register("validate_aspects", with_reviews(
    "SELECT ID, 'MainpositiveAspect' AS \"column\", MainpositiveAspect AS value FROM replied"
    f" WHERE MainpositiveAspect IS NOT NULL AND NOT list_contains({G.sql_list(C.POSITIVE_ASPECTS)},"
    " MainpositiveAspect)"
    " UNION ALL SELECT ID, 'MainAreaofImprovement', MainAreaofImprovement FROM replied"
    f" WHERE MainAreaofImprovement IS NOT NULL AND NOT list_contains({G.sql_list(C.NEGATIVE_ASPECTS)},"
    " MainAreaofImprovement)",
    G.ANSWERS_CTE, UNANSWERED, JOINED, f"replied AS (SELECT {G.row_select(G.reply_steps(ASOF))} FROM j)"))
def q_validate_aspects(spark, sf):
    replied = E.apply_reply(_unanswered(spark, sf), model_answers(spark, sf), FIXTURE_ASOF)
    return C.validate_aspects(replied)


@register("score_range_check", with_reviews(
    " UNION ALL ".join(
        f"SELECT ID, '{c}' AS \"column\", {c} AS value FROM replied"
        f" WHERE {c} IS NOT NULL AND NOT ({c} BETWEEN 1 AND 5)" for c in C.SCORE_COLUMNS),
    G.ANSWERS_CTE, UNANSWERED, JOINED, f"replied AS (SELECT {G.row_select(G.reply_steps(ASOF))} FROM j)"))
def q_score_range_check(spark, sf):
    replied = E.apply_reply(_unanswered(spark, sf), model_answers(spark, sf), FIXTURE_ASOF)
    return C.score_range_check(replied)


@register("sensitive_flag", with_reviews(
    f"SELECT ID, {G.sensitive('ReviewText')} AS sensitive FROM reviews"))
def q_sensitive_flag(spark, sf):
    r = reviews(spark, sf)
    return r.select("ID", C.sensitive_flag(F.col("ReviewText")).alias("sensitive"))


@register("empathy_floor", with_reviews(
    "SELECT ID, CAST(CASE WHEN (Response = '' OR Response IS NULL) THEN 1.0"
    f" WHEN length(Response) < {C.SHORT_REPLY_CHARS} AND NOT regexp_matches(Response, {G.q(C.GREETING_PATTERN)})"
    " THEN 2.0 END AS DOUBLE) AS empathy_floor FROM reviews"))
def q_empathy_floor(spark, sf):
    r = reviews(spark, sf)
    return r.select("ID", C.empathy_floor(F.col("Response")).alias("empathy_floor"))


_LINES = (f"list_distinct(list_filter(list_transform(string_split(Response, {G.NL}), lambda x: trim(x)),"
          f" lambda x: length(x) >= {C.BLOCK_MIN_CHARS}))")


@register("individuality_score", with_reviews(
    "SELECT k.ID, CAST(CASE WHEN contains(k.Response, '(Leer)') OR d.uses > 1 THEN 1.0"
    " WHEN coalesce(b.blocks, 0) >= 5 THEN 2.0 WHEN b.blocks >= 3 THEN 3.0 WHEN b.blocks = 2 THEN 4.0"
    " ELSE 5.0 END AS DOUBLE) AS individuality FROM keyed k JOIN dup d USING (h) LEFT JOIN blk b USING (ID)"
    " UNION ALL SELECT ID, CAST(1.0 AS DOUBLE) FROM reviews WHERE Response = '' OR Response IS NULL",
    f"keyed AS (SELECT ID, Response, sha256(Response) AS h FROM reviews WHERE {G.nonblank('Response')})",
    "dup AS (SELECT h, count(*) AS uses FROM keyed GROUP BY h)",
    f"lines AS (SELECT ID, h, unnest({_LINES}) AS line FROM keyed)",
    f"per_line AS (SELECT line, count(DISTINCT h) AS n FROM lines GROUP BY line"
    f" HAVING count(DISTINCT h) >= {C.BLOCK_MIN_REPLIES})",
    "blk AS (SELECT ID, count(*) AS blocks FROM lines WHERE line IN (SELECT line FROM per_line) GROUP BY ID)"))
def q_individuality_score(spark, sf):
    return C.individuality_score(reviews(spark, sf))


# Both engines render the request struct as compact JSON in field order, nulls left out.
def _req_json(generation: str) -> str:
    fixed = ("{'messages': [{'role': 'system', 'content': 'Answer in JSON.'}, {'role': 'user', 'content': content}],"
             f" 'max_tokens': {S.REPLY_MAX_TOKENS}, 'temperature': 1.0, 'top_p': 0.0, 'n': 1,"
             " 'presence_penalty': presence_penalty, 'frequency_penalty': 0.0")
    return (f"CASE WHEN ApprovalStatus = 'Regenerate' THEN to_json({fixed}, 'generation': {generation}}})"
            f" ELSE to_json({fixed}}}) END")


SYSTEM = "Answer in JSON."
_FIRST_GENERATION = "sha256(coalesce(Response, ''))"
_FILLED = (f"filled AS (SELECT * REPLACE (coalesce(Language, upper({G.detect_language()})) AS Language) FROM rows)")
_ASKED = (f"asked AS (SELECT *, sha256({_req_json(_FIRST_GENERATION)}) AS h FROM (SELECT ID, Response, ApprovalStatus,"
          f" {_REPLY_CONTENT} AS content, CASE WHEN ApprovalStatus = 'Regenerate' THEN 1.0 ELSE 0.0 END"
          " AS presence_penalty FROM filled WHERE Language IS NOT NULL))")
_NUMBER = "CAST(split_part(ID, '-', 2) AS BIGINT)"


def _filled(spark, sf):
    """Checkpointed, as the pipeline's stages do: requests are built from these rows more than once."""
    return C.fill_language(C.detect_language(_unanswered(spark, sf))).drop("detected_lang").checkpoint()


def _earlier_calls(requests, answers):
    """A ledger for the requests: by number of the review, none, answered, refused
    once (429), or failed twice (500).  The answer is the stored one of the ID."""
    n = F.split_part("ID", F.lit("-"), F.lit(2)).cast("long") % 4
    calls = F.when(n == 1, F.array(F.lit(200))).when(n == 2, F.array(F.lit(429))).when(n == 3, F.array(F.lit(500), F.lit(500)))
    # Only rows with a call, and of the texts only those that are answers, are shuffled.
    given = answers.filter("kind = 'reply'").filter(n > 0).select("ID", F.when(n == 1, F.col("content")).alias("content"))
    return E.with_request_hash(requests.filter(n > 0)).join(given, "ID").select(
        "ID", "kind", F.lit(None).cast("string").alias("field"), "request_hash", F.posexplode(calls).alias("k", "status"),
        F.col("content")).select("ID", "kind", "field", "request_hash", (F.col("k") + 1).alias("attempt"), "status",
                                 F.when(F.col("status") == 200, F.col("content")).alias("content"))


@register("infer_replies", with_reviews(
    f"SELECT ID, 'reply' AS kind, h AS request_hash, CAST(CASE {_NUMBER} % 4 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS INTEGER) AS attempts,"
    f" CASE WHEN {_NUMBER} % 4 = 1 THEN a.content END AS content FROM asked JOIN answers a USING (ID)",
    G.ANSWERS_CTE, UNANSWERED, _FILLED, _ASKED))
def q_infer_replies(spark, sf):
    """Around the model call: the reply requests of the unanswered work-list against
    a ledger of answered, refused and failed calls.  Rows without content are the
    requests that ``infer_replies`` would send, with the calls made so far; the
    others were answered, and the answer is that of their own request."""
    requests = E.reply_requests(_filled(spark, sf), SYSTEM)
    ledger = _earlier_calls(requests.drop("content"), model_answers(spark, sf)).checkpoint()
    todo = E.open_requests(requests, ledger).select("ID", "kind", "request_hash", "attempts", F.lit(None).cast("string").alias("content"))
    return todo.unionByName(E.given_answers(requests, ledger).select(
        "ID", F.lit("reply").alias("kind"), "request_hash", F.col("attempt").alias("attempts"), "content"))


def _answers_to(requests):
    """Stand-in ledger: one answered call per request, told apart by its hash."""
    return E.with_request_hash(requests).select(
        "ID", "kind", F.lit(None).cast("string").alias("field"), "request_hash", F.lit(1).alias("attempt"), F.lit(200).alias("status"),
        F.concat(F.lit('{"Response": "Reply '), F.substring("request_hash", 1, 12), F.lit('"}')).alias("content"))


@register("regenerate_twice", with_reviews(
    "SELECT ID, first_reply, 'Reply ' || substr(h, 1, 12) AS second_reply, 'Pending' AS ApprovalStatus FROM ("
    f" SELECT ID, first_reply, sha256({_req_json('sha256(first_reply)')}) AS h"
    " FROM (SELECT *, 'Reply ' || substr(h, 1, 12) AS first_reply FROM asked WHERE ApprovalStatus = 'Regenerate'))",
    UNANSWERED, _FILLED, _ASKED))
def q_regenerate_twice(spark, sf):
    """Rows marked ``Regenerate`` twice in turn: each round makes a new request and takes
    the answer to it out of a ledger that holds the answers of all rounds."""
    rows = _filled(spark, sf).filter("ApprovalStatus = 'Regenerate'")
    ledger = _answers_to(E.reply_requests(rows, SYSTEM))
    once = E.apply_reply(rows, ledger, FIXTURE_ASOF, system=SYSTEM).checkpoint()
    again = once.withColumn("ApprovalStatus", F.lit("Regenerate"))
    ledger = ledger.unionByName(_answers_to(E.reply_requests(again, SYSTEM)))
    twice = E.apply_reply(again, ledger, FIXTURE_ASOF, system=SYSTEM)
    return once.select("ID", F.col("Response").alias("first_reply")).join(
        twice.select("ID", F.col("Response").alias("second_reply"), "ApprovalStatus"), "ID")


# -- a ledger with answers to earlier requests --------------------------------
# Every ID has a later call that answers an earlier request; the request as it is now
# was answered (or failed) for two IDs of three.

_CURRENT = f"now AS (SELECT * FROM answers WHERE {_NUMBER} % 3 <> 0)"
_STALE = ('{"Response": "OLD", "SensitiveTopic": "Yes", "StateRegion": "OLD", "Country": "OLD", "MainpositiveAspect": "OLD",'
          ' "MainAreaofImprovement": "OLD", "EmpathyScore": 1, "HelpfulnessScore": 1, "IndividualityScore": 1}')


def _joined_now(rows: str) -> str:
    return (f"j AS (SELECT {rows}.*, a.status AS _status, {G.answer_obj('a.content')} AS obj FROM {rows}"
            " LEFT JOIN now a USING (ID))")


def _with_stale(requests, answers, stale):
    """``answers`` (by ID, kind and, if both have one, field) under the hash of their request, and a
    later answered call of an earlier request with ``stale``."""
    keys = ["ID", "kind", *[k for k in ("field",) if k in requests.columns]]
    asked = E.with_request_hash(requests).select(*keys, "request_hash")
    field = F.col("field") if "field" in keys else F.lit(None).cast("string")
    n = F.split_part("ID", F.lit("-"), F.lit(2)).cast("long")
    now = answers.filter(n % 3 != 0).join(asked, keys).select("ID", "kind", field.alias("field"), "request_hash", "attempt", "status", "content")
    old = asked.select("ID", "kind", field.alias("field"), F.sha2(F.concat(F.lit("earlier "), "request_hash"), 256).alias("request_hash"),
                       F.lit(9).alias("attempt"), F.lit(200).alias("status"), F.lit(stale).alias("content"))
    return now.unionByName(old).checkpoint()


@register("apply_reply_by_request", with_reviews(
    f"SELECT {G.row_select(G.reply_steps(ASOF))} FROM j", G.ANSWERS_CTE, UNANSWERED, _FILLED, _CURRENT, _joined_now("filled")))
def q_apply_reply_by_request(spark, sf):
    rows = _filled(spark, sf)
    ledger = _with_stale(E.reply_requests(rows, SYSTEM).drop("content"), model_answers(spark, sf), _STALE)
    return E.apply_reply(rows, ledger, FIXTURE_ASOF, system=SYSTEM)


@register("apply_completion_by_request", with_reviews(
    f"SELECT {G.row_select(G.completion_steps())} FROM j", G.ANSWERS_CTE, _INCOMPLETE, _CURRENT, _joined_now("rows")))
def q_apply_completion_by_request(spark, sf):
    rows = W.incomplete_rows(reviews(spark, sf))
    ledger = _with_stale(E.completion_requests(rows, SYSTEM), model_answers(spark, sf), _STALE)
    return E.apply_completion(rows, ledger, system=SYSTEM)


@register("apply_translation_by_request", with_reviews(
    f"SELECT {G.row_select(_TRANSLATION_OUT)} FROM rows LEFT JOIN tfirst USING (ID)"
    " LEFT JOIN terr USING (ID) LEFT JOIN ttried USING (ID)",
    _TRANSLATE_ROWS, _TREQ.replace("treq AS", "treq0 AS"), f"treq AS (SELECT * FROM treq0 WHERE {_NUMBER} % 3 <> 0)",
    _TANS, _TGOOD, _TERR, _TTRIED))
def q_apply_translation_by_request(spark, sf):
    rows = W.translate_candidates(reviews(spark, sf))
    req = E.translation_requests(rows, SYSTEM)
    ledger = _with_stale(req, translation_answers(spark, sf, req), "This is the OLD text of the review and it is from the team")
    return E.apply_translation(rows, ledger.withColumn("lang", C.text_language(F.col("content"))), system=SYSTEM)
