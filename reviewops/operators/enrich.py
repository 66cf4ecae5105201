"""Model-backed enrichment: request building and answer application.

The model itself is injected (see ``infer_replies``); everything around it is
set-based: requests are columns built from the row, answers are a ledger
(``LEDGER_SCHEMA``) joined back on ``ID`` and the hash of the request these rows
make now, so that an answer to an earlier request is never applied (a ledger
without hashes, ``ANSWER_SCHEMA``, is joined on ``ID`` alone) -- with one ``CASE``
per column.  The ledger holds all days: it is first reduced to the
work-list's IDs and to status and attempt numbers, and only the picked
attempts' text is fetched.

Decision table of the reply stage (each step needs the previous one; a
missing answer key stops at that step, leaving earlier columns set):

a. request failed (non-2xx)            -> DeveloperComment = status code
b. answer has no parsable object        -> row unchanged (reason in the log)
c. row was ``Regenerate``               -> Response = answer, status Pending
d. otherwise                            -> SensitiveTopic = answer
e. Location present                     -> StateRegion, Country = answer
f. answer Response blank or ``(Leer)``  -> stop here
g. stored Response blank                -> Response, EstResponseDate, ResponseTimeDays,
                                           both aspects, status Pending
h. always after f (g completed if taken)-> the three scores
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.answers import answer_get, answer_has, answer_object
from ..functions.text import blank_or_null, nonblank, strip_labels, try_double, unescape_newline
from .classify import reply_language

# Labels of the user message parts sent with each request.
LANG_TITLE, LANG_TEXT, LANG_LOCATION = "Title: ", "\nText: ", "\n(Location: "
REPLY_TITLE, REPLY_RATING, REPLY_PLACE, REPLY_LANG = (
    "Bewertungstitel: ", "\n\n(Bewertung insgesamt: ", "\n\n(Ort: ", "\n\n(Sprache: ")
COMPLETION_PLACE = "\n(Ort: "


def _c(n: str) -> Column:
    return F.col(n)


def _fstr(c: Column) -> Column:
    """Python f-string rendering of a value: NULL -> ``None``."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def _is_2xx(status: Column) -> Column:
    return status.between(200, 299)


# ---------------------------------------------------------------------------
# Requests

def request_struct(messages: Column, max_tokens: int, temperature: float,
                   presence_penalty: Column | float = 0.0, generation: Column | None = None) -> Column:
    """``generation`` (left out of the JSON where null) tells requests apart that
    ask for a new answer to the same messages."""
    generation = F.lit(None).cast("string") if generation is None else generation
    pp = presence_penalty if isinstance(presence_penalty, Column) else F.lit(float(presence_penalty))
    return F.struct(messages.alias("messages"), F.lit(max_tokens).alias("max_tokens"),
                    F.lit(float(temperature)).alias("temperature"), F.lit(0.0).alias("top_p"),
                    F.lit(1).alias("n"), pp.alias("presence_penalty"),
                    F.lit(0.0).alias("frequency_penalty"), generation.alias("generation"))


def _msg(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _messages(system: str | None, *user: Column) -> Column:
    """The system message, if one is given (its wording is the caller's), then the
    user messages.  It is part of the request, so a changed prompt is a new request."""
    first = [_msg("system", F.lit(system))] if system else []
    return F.array(*first, *[_msg("user", u) for u in user])


def language_content() -> Column:
    text = strip_labels(_c("Portal"), _c("ReviewText"))
    return F.concat(
        F.lit(LANG_TITLE), F.coalesce(_c("ReviewTitle"), F.lit("")),
        F.when(nonblank(text), F.concat(F.lit(LANG_TEXT), text)).otherwise(F.lit("")),
        F.when(nonblank(_c("Location")), F.concat(F.lit(LANG_LOCATION), _c("Location"), F.lit(")")))
        .otherwise(F.lit("")))


def language_requests(rows: DataFrame, system: str | None = None) -> DataFrame:
    """One request per row whose Language is unknown."""
    content = language_content()
    return rows.filter(_c("Language").isNull()).select(
        "ID", F.lit("language").alias("kind"), content.alias("content"),
        request_struct(_messages(system, content), S.LANGUAGE_MAX_TOKENS, 0).alias("request"))


def reply_content(lang: Column) -> Column:
    return F.concat(
        F.lit(REPLY_TITLE), _fstr(_c("ReviewTitle")), F.lit("\n\n"), _fstr(_c("ReviewText")),
        F.lit(REPLY_RATING), _fstr(_c("OverallSatisfaction")), F.lit("/5.0)"),
        F.when(nonblank(_c("Location")), F.concat(F.lit(REPLY_PLACE), _c("Location"), F.lit(")")))
        .otherwise(F.lit("")),
        F.when(nonblank(lang), F.concat(F.lit(REPLY_LANG), lang, F.lit(")"))).otherwise(F.lit("")))


def reply_requests(rows: DataFrame, system: str | None = None) -> DataFrame:
    """Rows need a known Language (run ``fill_language`` first); regeneration
    requests carry presence penalty 1 and, as their generation, the SHA-256 of
    the reply to be replaced: a second regeneration is a new request."""
    lang = reply_language(_c("Language"), _c("Portal"))
    content = reply_content(lang)
    again = _c("ApprovalStatus") == "Regenerate"
    pp = F.when(again, F.lit(1.0)).otherwise(F.lit(0.0))
    generation = F.when(again, F.sha2(F.coalesce(_c("Response"), F.lit("")), 256))
    return rows.filter(_c("Language").isNotNull()).select(
        "ID", F.lit("reply").alias("kind"), lang.alias("reply_lang"), content.alias("content"),
        pp.alias("presence_penalty"),
        request_struct(_messages(system, content), S.REPLY_MAX_TOKENS, 1, pp, generation).alias("request"))


def completion_requests(rows: DataFrame, system: str | None = None) -> DataFrame:
    """Review (+ place) and the posted reply as two user messages."""
    review = F.concat(_c("ReviewText"), F.when(nonblank(_c("Location")), F.concat(
        F.lit(COMPLETION_PLACE), _c("Location"), F.lit(")"))).otherwise(F.lit("")))
    return rows.filter(_c("Response").isNotNull()).select(
        "ID", F.lit("completion").alias("kind"), review.alias("review_content"),
        _c("Response").alias("reply_content"),
        request_struct(_messages(system, review, _c("Response")), S.REPLY_MAX_TOKENS, 0).alias("request"))


def translation_requests(rows: DataFrame, system: str | None = None) -> DataFrame:
    """One request per (ID, field) still blank, for rows not in English.
    Review text that is only rating labels is copied, not translated; blank
    source text is never sent."""
    not_en = _c("Language").isNull() | (_c("Language") != "EN")
    review_ok = blank_or_null(_c("ReviewTextEN")) & nonblank(strip_labels(_c("Portal"), _c("ReviewText")))
    reply_ok = blank_or_null(_c("ResponseEN")) & nonblank(_c("Response"))
    items = F.filter(F.array(
        F.when(review_ok, F.struct(F.lit("ReviewTextEN").alias("field"), _c("ReviewText").alias("source"))),
        F.when(reply_ok, F.struct(F.lit("ResponseEN").alias("field"), _c("Response").alias("source")))),
        lambda x: x.isNotNull())
    return rows.filter(not_en).select("ID", F.inline(items)).select(
        "ID", F.lit("translation").alias("kind"), "field", "source",
        request_struct(_messages(system, _c("source")), S.REPLY_MAX_TOKENS, 0).alias("request"))


# ---------------------------------------------------------------------------
# Answers

LEDGER_SCHEMA = T.StructType([
    T.StructField("ID", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("request_hash", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("content", T.StringType()),
])


# Answers whose requests are not known (applied by ID alone).
ANSWER_SCHEMA = T.StructType([f for f in LEDGER_SCHEMA.fields if f.name != "request_hash"])


def asked(answers: DataFrame, wanted: DataFrame) -> DataFrame:
    """Ledger rows that answer ``wanted``: those of its IDs and, where it has them,
    of its fields and request hashes."""
    keys = [k for k in ("ID", "field", "request_hash") if k in wanted.columns]
    return answers.join(wanted.select(*keys), keys, "left_semi")


def _wanted(rows: DataFrame, answers: DataFrame, requests: DataFrame | None, build, system: str | None) -> DataFrame:
    """What ``asked`` takes: the keys of ``requests``; or, if none are given, of the
    requests that ``rows`` make now if the ledger says which request it answers, else their IDs."""
    if requests is None and "request_hash" in answers.columns:
        requests = build(rows, system)
    if requests is None:
        return rows.select("ID")
    return with_request_hash(requests).select(*[k for k in ("ID", "field", "request_hash") if k != "field" or k in requests.columns])


def latest_answer(answers: DataFrame, kind: str) -> DataFrame:
    """Last attempt per ID for one request kind.  The pick is made on numbers and
    a content hash (a total order, so ties cannot flip); its text is joined last."""
    a = answers.filter(_c("kind") == kind).withColumn("_h", F.xxhash64("content"))
    last = a.groupBy("ID").agg(F.max(F.struct("attempt", "status", "_h")).alias("_l")).select("ID", "_l.*")
    text = a.select("ID", "attempt", "status", "_h", "content").dropDuplicates(["ID", "attempt", "status", "_h"])
    return last.join(text, ["ID", "attempt", "status", "_h"]).select(
        "ID", _c("status").alias("_status"), _c("content").alias("_content"))


# Keys looked up in a parsed answer (each once per row, see ``_apply``).
ANSWER_KEYS = ("Response", "SensitiveTopic", "StateRegion", "Country", "MainpositiveAspect",
               "MainAreaofImprovement", "EmpathyScore", "HelpfulnessScore", "IndividualityScore")


def _has(k: str) -> Column:
    return _c(f"_has_{k}")


def _get(k: str) -> Column:
    return _c(f"_get_{k}")


def _reply_steps(asof: _dt.date) -> dict[str, Column]:
    status, obj = _c("_status"), _c("_obj")
    has, get = _has, _get
    answered = status.isNotNull()
    failed = answered & ~_is_2xx(status)
    ok = answered & _is_2xx(status) & obj.isNotNull()
    regen = ok & (F.coalesce(_c("ApprovalStatus"), F.lit("")) == "Regenerate")
    regen_ok = regen & has("Response")
    d = ok & ~regen & has("SensitiveTopic")
    loc = nonblank(_c("Location"))
    e_state = d & loc & has("StateRegion")
    e_country = e_state & has("Country")
    after_e = d & (~loc | e_country)
    resp = get("Response")
    f = after_e & has("Response") & (resp != "") & ~resp.contains("(Leer)")
    g = f & blank_or_null(_c("Response"))
    g_days = g & _c("ReviewDate").isNotNull()
    g_pos = g_days & has("MainpositiveAspect")
    g_neg = g_pos & has("MainAreaofImprovement")
    h0 = f & (~blank_or_null(_c("Response")) | g_neg)
    h1 = h0 & has("EmpathyScore")
    h2 = h1 & has("HelpfulnessScore")
    h3 = h2 & has("IndividualityScore")
    keep = _c
    return {
        "Response": F.when(regen_ok | g, unescape_newline(resp)).otherwise(keep("Response")),
        "ApprovalStatus": F.when(regen_ok | g_neg, F.lit("Pending")).otherwise(keep("ApprovalStatus")),
        "SensitiveTopic": F.when(d, get("SensitiveTopic")).otherwise(keep("SensitiveTopic")),
        "StateRegion": F.when(e_state, get("StateRegion")).otherwise(keep("StateRegion")),
        "Country": F.when(e_country, get("Country")).otherwise(keep("Country")),
        "EstResponseDate": F.when(g, F.lit(asof)).otherwise(keep("EstResponseDate")),
        "ResponseTimeDays": F.when(g_days, F.datediff(F.lit(asof), _c("ReviewDate")))
                             .otherwise(keep("ResponseTimeDays")),
        "MainpositiveAspect": F.when(g_pos, get("MainpositiveAspect")).otherwise(keep("MainpositiveAspect")),
        "MainAreaofImprovement": F.when(g_neg, get("MainAreaofImprovement"))
                                  .otherwise(keep("MainAreaofImprovement")),
        "EmpathyScore": F.when(h1, try_double(get("EmpathyScore"))).otherwise(keep("EmpathyScore")),
        "HelpfulnessScore": F.when(h2, try_double(get("HelpfulnessScore")))
                             .otherwise(keep("HelpfulnessScore")),
        "IndividualityScore": F.when(h3, try_double(get("IndividualityScore")))
                               .otherwise(keep("IndividualityScore")),
        "DeveloperComment": F.when(failed, status.cast("string")).otherwise(keep("DeveloperComment")),
        "_outcome": (F.when(~answered, F.lit("no answer")).when(failed, F.lit("request failed"))
                     .when(obj.isNull(), F.lit("unparsable answer"))
                     .when(regen, F.when(regen_ok, F.lit("regenerated")).otherwise(F.lit("missing key")))
                     .when(~after_e, F.lit("missing key"))
                     .when(~f, F.when(has("Response"), F.lit("no reply needed"))
                           .otherwise(F.lit("missing key")))
                     .when(~h3, F.lit("missing key"))
                     .otherwise(F.lit("answered"))),
    }


def _apply(rows: DataFrame, answers: DataFrame, kind: str, steps: dict[str, Column],
           with_outcome: bool, wanted: DataFrame) -> DataFrame:
    j = rows.join(latest_answer(asked(answers, wanted), kind), "ID", "left")
    # The answer is parsed once and every key looked up once, each in its own
    # projection: the decision table refers to these columns many times, and
    # the optimizer does not inline an expensive expression used repeatedly.
    j = j.withColumn("_obj", answer_object(_c("_content")))
    j = j.select("*", *[answer_has(_c("_obj"), k).alias(f"_has_{k}") for k in ANSWER_KEYS],
                 *[answer_get(_c("_obj"), k).alias(f"_get_{k}") for k in ANSWER_KEYS])
    cols = [steps[c].cast(rows.schema[c].dataType).alias(c) if c in steps else _c(c)
            for c in rows.columns]
    if with_outcome:
        cols.append(steps["_outcome"].alias("outcome"))
    return j.select(*cols)


def apply_reply(rows: DataFrame, answers: DataFrame, asof: _dt.date,
                with_outcome: bool = False, requests: DataFrame | None = None, system: str | None = None) -> DataFrame:
    """Apply reply answers (kind ``reply``) per the decision table above: the last
    answer to the request of each row (``requests``, by default those that the rows
    make with ``system``), or, from a ledger without request hashes, to its ID."""
    wanted = _wanted(rows, answers, requests, reply_requests, system)
    return _apply(rows, answers, "reply", _reply_steps(asof), with_outcome, wanted)


def _completion_steps() -> dict[str, Column]:
    status, obj = _c("_status"), _c("_obj")
    has, get = _has, _get
    answered = status.isNotNull()
    failed = answered & ~_is_2xx(status)
    ok = answered & _is_2xx(status) & obj.isNotNull() & _c("Response").isNotNull()
    loc = nonblank(_c("Location"))
    s1 = ok & (~loc | has("StateRegion"))
    state = ok & loc & has("StateRegion")
    s2 = s1 & (~loc | has("Country"))
    country = state & has("Country")
    s3 = s2 & has("SensitiveTopic")
    s4 = s3 & has("MainpositiveAspect")
    s5 = s4 & has("MainAreaofImprovement")
    # float(x) raises on a non-number: later steps stop there
    emp, hlp, ind = (try_double(get(k)) for k in S_SCORE_KEYS)
    s6 = s5 & has("EmpathyScore") & emp.isNotNull()
    s7 = s6 & has("HelpfulnessScore") & hlp.isNotNull()
    s8 = s7 & has("IndividualityScore") & ind.isNotNull()
    keep = _c
    return {
        "StateRegion": F.when(state, get("StateRegion")).otherwise(keep("StateRegion")),
        "Country": F.when(country, get("Country")).otherwise(keep("Country")),
        "SensitiveTopic": F.when(s3, get("SensitiveTopic")).otherwise(keep("SensitiveTopic")),
        "MainpositiveAspect": F.when(s4, get("MainpositiveAspect")).otherwise(keep("MainpositiveAspect")),
        "MainAreaofImprovement": F.when(s5, get("MainAreaofImprovement"))
                                  .otherwise(keep("MainAreaofImprovement")),
        "EmpathyScore": F.when(s6, emp).otherwise(keep("EmpathyScore")),
        "HelpfulnessScore": F.when(s7, hlp).otherwise(keep("HelpfulnessScore")),
        "IndividualityScore": F.when(s8, ind).otherwise(keep("IndividualityScore")),
        "DeveloperComment": F.when(failed, status.cast("string")).otherwise(keep("DeveloperComment")),
        "_outcome": (F.when(~answered, F.lit("no answer")).when(failed, F.lit("request failed"))
                     .when(obj.isNull(), F.lit("unparsable answer"))
                     .when(~s8, F.lit("missing key")).otherwise(F.lit("answered"))),
    }


S_SCORE_KEYS = ("EmpathyScore", "HelpfulnessScore", "IndividualityScore")


def apply_completion(rows: DataFrame, answers: DataFrame, with_outcome: bool = False,
                     requests: DataFrame | None = None, system: str | None = None) -> DataFrame:
    """Apply completion answers (kind ``completion``): place (only with a
    Location), sensitive flag, aspects, scores as numbers.  The language of
    rows still without one is filled by ``fill_language`` afterwards.  Which answers
    are taken: see ``apply_reply``."""
    wanted = _wanted(rows, answers, requests, completion_requests, system)
    return _apply(rows, answers, "completion", _completion_steps(), with_outcome, wanted)


def apply_translation(rows: DataFrame, answers: DataFrame, tries: int = S.TRANSLATION_TRIES,
                      requests: DataFrame | None = None, system: str | None = None) -> DataFrame:
    """English rows copy both originals into the EN columns.  Other rows take,
    per field, the first of ``tries`` answers that is verified English (``lang``
    column of the ledger, e.g. from ``text_language``; a failed call uses up no
    try); rating-only review text is copied; a field that never verified sets
    ``DeveloperComment = 'Check lang'``; a failed request sets
    ``'<code>(translation)'`` (the last failure wins).  Tries, failures and texts are
    those of the field's request as it is now, not of one for an older text; see
    ``apply_reply`` for which answers are taken."""
    a = asked(answers.filter(_c("kind") == "translation"),
              _wanted(rows, answers, requests, translation_requests, system)).withColumn("_h", F.xxhash64("content"))
    ok = _is_2xx(_c("status"))
    # numbers first: the calls of one field that were answered, in order (a
    # client's bounded retries), the last failure, the fields tried (two at most)
    per_field = a.groupBy("ID", "field").agg(
        F.sort_array(F.collect_list(F.when(ok, F.struct(
            "attempt", F.coalesce(_c("lang") == "EN", F.lit(False)).alias("en"), "_h")))).alias("calls"),
        F.max(F.when(~ok, F.struct("attempt", "status"))).alias("err"))
    first = F.try_element_at(F.filter(F.slice("calls", 1, tries), lambda x: x["en"]), F.lit(1))
    picked = per_field.select("ID", "field", "err", first["attempt"].alias("attempt"), first["_h"].alias("_h"))
    text = a.filter(ok).select("ID", "field", "attempt", "_h", "content").dropDuplicates(["ID", "field", "attempt", "_h"])
    found = picked.join(text, ["ID", "field", "attempt", "_h"], "left")
    per_id = found.groupBy("ID").agg(
        F.max(F.when(_c("field") == "ReviewTextEN", _c("content"))).alias("_rev"),
        F.max(F.when(_c("field") == "ResponseEN", _c("content"))).alias("_resp"),
        F.max(F.struct(_c("err.attempt").alias("attempt"), "field", _c("err.status").alias("status")))["status"].alias("_err"),
        F.collect_set("field").alias("_fields"))
    j = rows.join(per_id, "ID", "left")
    is_en = F.coalesce(_c("Language") == "EN", F.lit(False))
    labels_only = blank_or_null(strip_labels(_c("Portal"), _c("ReviewText")))
    rev_needed = ~is_en & blank_or_null(_c("ReviewTextEN")) & ~labels_only
    resp_needed = ~is_en & blank_or_null(_c("ResponseEN")) & nonblank(_c("Response"))
    rev_failed = rev_needed & F.array_contains(F.coalesce(_c("_fields"), F.array()), "ReviewTextEN") \
        & _c("_rev").isNull()
    resp_failed = resp_needed & F.array_contains(F.coalesce(_c("_fields"), F.array()), "ResponseEN") \
        & _c("_resp").isNull()
    new = {
        "ReviewTextEN": F.when(is_en, _c("ReviewText"))
                         .when(~blank_or_null(_c("ReviewTextEN")), _c("ReviewTextEN"))
                         .when(labels_only, _c("ReviewText"))
                         .otherwise(F.coalesce(_c("_rev"), _c("ReviewTextEN"))),
        "ResponseEN": F.when(is_en, _c("Response"))
                       .when(~blank_or_null(_c("ResponseEN")), _c("ResponseEN"))
                       .otherwise(F.coalesce(_c("_resp"), _c("ResponseEN"))),
        "DeveloperComment": F.when(rev_failed | resp_failed, F.lit("Check lang"))
                             .when(_c("_err").isNotNull() & ~is_en,
                                   F.concat(_c("_err").cast("string"), F.lit("(translation)")))
                             .otherwise(_c("DeveloperComment")),
    }
    return j.select(*[new[c].alias(c) if c in new else _c(c) for c in rows.columns])


def request_errors(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Requests that failed at their last attempt, per ID and kind: the last failing
    status and the comment the apply step writes.  A request that was answered
    later is none of them; with request hashes each request is judged by itself."""
    request = [k for k in ("field", "request_hash") if k in answers.columns]
    last = answers.groupBy("ID", "kind", *request).agg(F.max(F.struct("attempt", "status")).alias("l"))
    last = last.filter(~_is_2xx(_c("l.status"))).groupBy("ID", "kind").agg(F.max("l")["status"].alias("status"))
    comment = F.when(_c("kind") == "translation",
                     F.concat(_c("status").cast("string"), F.lit("(translation)"))) \
        .otherwise(_c("status").cast("string"))
    return last.join(rows.select("ID"), "ID", "left_semi").select(
        "ID", "kind", "status", comment.alias("DeveloperComment"))


# ---------------------------------------------------------------------------
# Running the injected client

ClientFn = Callable[[pd.DataFrame], pd.DataFrame]

def with_request_hash(requests: DataFrame) -> DataFrame:
    return requests.withColumn("request_json", F.to_json(_c("request"))) \
        .withColumn("request_hash", F.sha2(_c("request_json"), 256))


def open_requests(requests: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Requests that the ledger holds no 2xx answer for: ``ID``, ``kind``, ``field``,
    ``request_hash``, ``request_json`` and ``attempts``, the calls made so far.

    The hashed requests are laid down once (``checkpoint``): they are joined twice
    (to reduce the ledger, and with what is left of it), and their JSON, built from
    whatever made the rows, would be too much code for one compiled stage."""
    req = with_request_hash(requests)
    field = _c("field") if "field" in req.columns else F.lit(None).cast("string")
    req = req.select("ID", "kind", field.alias("field"), "request_hash", "request_json").checkpoint()
    if ledger is None:
        return req.withColumn("attempts", F.lit(0))
    past = asked(ledger, req.select("ID", "request_hash")).groupBy("ID", "field", "request_hash").agg(
        F.max("attempt").alias("_past"), F.bool_or(_is_2xx(_c("status"))).alias("_done")) \
        .select(_c("ID").alias("_i"), _c("field").alias("_f"), _c("request_hash").alias("_r"), "_past", "_done")
    left = req.join(past, (_c("ID") == _c("_i")) & _c("field").eqNullSafe(_c("_f"))
                    & (_c("request_hash") == _c("_r")), "left").filter(~F.coalesce(_c("_done"), F.lit(False)))
    return left.select(*req.columns, F.coalesce("_past", F.lit(0)).cast("int").alias("attempts"))


def given_answers(requests: DataFrame, ledger: DataFrame, kind: str = "reply") -> DataFrame:
    """The last 2xx answer of the ledger to each of ``requests``: ``ID``, ``request_hash``,
    ``attempt``, ``status``, ``content``."""
    keys = with_request_hash(requests).select("ID", "request_hash")
    a = asked(ledger.filter((_c("kind") == kind) & _is_2xx(_c("status"))), keys).withColumn("_h", F.xxhash64("content"))
    last = a.groupBy("ID", "request_hash").agg(F.max(F.struct("attempt", "status", "_h")).alias("l")).select("ID", "request_hash", "l.*")
    text = a.select("ID", "request_hash", "attempt", "status", "_h", "content").dropDuplicates(["ID", "request_hash", "attempt", "status", "_h"])
    return last.join(text, ["ID", "request_hash", "attempt", "status", "_h"]).drop("_h")


def infer_replies(requests: DataFrame, client: ClientFn, ledger: DataFrame | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Run ``client`` over requests without an answer in the ledger.

    ``client`` gets a pandas frame ``ID, kind, field, request_hash,
    request_json`` (one Arrow batch) and returns the ledger's columns, with
    ``attempt`` counted from 1; see ``retrying`` for bounded retries.  A request
    is done once the ledger holds a 2xx row for its ID, field and hash: a re-run
    or a retried task never pays twice for it, while failed calls are asked
    again, their attempts counted on from the ledger's.  ``partitions`` bounds
    the number of concurrent callers.
    """
    req = open_requests(requests, ledger)
    if partitions:
        req = req.repartition(partitions, "ID")
    keys = ["ID", "_field", "request_hash"]

    def keyed(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(_field=["" if pd.isna(x) else x for x in pdf["field"]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                past = keyed(pdf)[[*keys, "attempts"]].drop_duplicates(keys)
                out = keyed(client(pdf.drop(columns="attempts"))).merge(past, on=keys)
                yield out.assign(attempt=out["attempt"] + out["attempts"])[[f.name for f in LEDGER_SCHEMA.fields]]

    return req.mapInPandas(run, LEDGER_SCHEMA)


def retrying(client: ClientFn, tries: int = 3, wait: Callable[[int], None] | None = None) -> ClientFn:
    """``client`` with up to ``tries`` calls per request: what was not answered (no
    2xx) is asked again after ``wait(call number)``.  Every call is a ledger row."""

    def call(pdf: pd.DataFrame) -> pd.DataFrame:
        done, left = [], pdf
        for n in range(1, tries + 1):
            out = client(left).assign(attempt=n)
            done.append(out)
            failed = out[~out["status"].between(200, 299)]
            if not len(failed):
                break
            again = set(zip(failed["ID"], failed["request_hash"], strict=True))
            left = left[[k in again for k in zip(left["ID"], left["request_hash"], strict=True)]]
            if wait and n < tries:
                wait(n)
        return pd.concat(done, ignore_index=True)

    return call


def outcome_log(applied: DataFrame) -> DataFrame:
    """Run-log rows ``(ID, reason)`` for rows an apply step left (partly)
    unchanged: failed request, unparsable answer, missing key.  Input is an
    ``apply_*(..., with_outcome=True)`` result."""
    bad = ~_c("outcome").isin("answered", "no answer", "regenerated", "no reply needed")
    return applied.filter(bad).select("ID", _c("outcome").alias("reason"))
