"""Decision table of the reply stage, completion and translation rules."""
import datetime as dt
import json

import pandas as pd

from pyspark.sql import functions as F

from conftest import rows
from reviewops.operators import classify as C
from reviewops.operators import enrich as E
from reviewops.operators.merge import schema_conform

ASOF = dt.date(2024, 1, 31)


def _echo():
    def client(pdf):
        """Stand-in model: answers every request with a text that names its hash."""
        return pd.DataFrame({"ID": pdf["ID"], "kind": pdf["kind"], "field": pdf["field"], "request_hash": pdf["request_hash"],
                             "attempt": 1, "status": 200, "content": "Reply " + pdf["request_hash"].str.slice(0, 12)})

    return client


# A local function travels to the workers by value (they cannot import tests).
echo_client = _echo()


def _rows(spark, data):
    df = spark.createDataFrame(
        data, "ID string, ApprovalStatus string, Location string, Response string, ReviewDate date")
    return schema_conform(df)


def _answers(spark, data):
    return spark.createDataFrame([(i, "reply", None, 1, s, c) for i, s, c in data],
                                 E.ANSWER_SCHEMA)


FULL = {"Response": "Hallo\\nDanke", "StateRegion": "Bayern", "Country": "Germany",
        "MainPositiveAspect": "Colleagues", "MainAreaOfImprovement": "Poor Salary",
        "SensitiveTopic": "No", "EmpathyScore": 4, "HelpfulnessScore": "3", "IndividualityScore": 5}


def _content(d):
    return "Sure: " + json.dumps(d) + " ok"


def test_reply_decision_table(spark):
    d = dt.date(2024, 1, 21)
    r = _rows(spark, [
        ("failed", None, "Bonn", None, d),
        ("garbled", None, "Bonn", None, d),
        ("regen", "Regenerate", "Bonn", "old", d),
        ("noloc", None, None, None, d),
        ("leer", None, "Bonn", None, d),
        ("answered", "Approved", "Bonn", "kept", d),
        ("full", None, "Bonn", "", d),
        ("nodate", None, "Bonn", None, None),
        ("missing", None, "Bonn", None, d),
        ("unanswered", None, "Bonn", None, d),
    ])
    a = _answers(spark, [
        ("failed", 500, None), ("garbled", 200, "no json"), ("regen", 200, _content(FULL)),
        ("noloc", 200, _content(FULL)), ("leer", 200, _content(dict(FULL, Response="(Leer)"))),
        ("answered", 200, _content(FULL)), ("full", 200, _content(FULL)),
        ("nodate", 200, _content(FULL)),
        ("missing", 200, _content({k: v for k, v in FULL.items() if k != "Country"})),
    ])
    out = {x["ID"]: x.asDict() for x in E.apply_reply(r, a, ASOF, with_outcome=True).collect()}
    assert out["failed"]["DeveloperComment"] == "500" and out["failed"]["Response"] is None
    assert out["garbled"]["outcome"] == "unparsable answer" and out["garbled"]["SensitiveTopic"] is None
    g = out["regen"]
    assert (g["Response"], g["ApprovalStatus"], g["SensitiveTopic"]) == ("Hallo\nDanke", "Pending", None)
    n = out["noloc"]
    assert n["StateRegion"] is None and n["SensitiveTopic"] == "No" and n["Response"] == "Hallo\nDanke"
    lr = out["leer"]
    assert lr["Response"] is None and lr["Country"] == "Germany" and lr["EmpathyScore"] is None
    k = out["answered"]
    assert k["Response"] == "kept" and k["ApprovalStatus"] == "Approved" and k["EmpathyScore"] == 4.0
    f = out["full"]
    assert f["Response"] == "Hallo\nDanke" and f["ResponseTimeDays"] == 10
    assert f["EstResponseDate"] == ASOF and f["MainpositiveAspect"] == "Colleagues"
    assert f["HelpfulnessScore"] == 3.0 and f["ApprovalStatus"] == "Pending"
    nd = out["nodate"]
    assert nd["Response"] == "Hallo\nDanke" and nd["ResponseTimeDays"] is None
    assert nd["MainpositiveAspect"] is None and nd["EmpathyScore"] is None
    m = out["missing"]
    assert m["StateRegion"] == "Bayern" and m["Country"] is None and m["Response"] is None
    assert out["unanswered"]["outcome"] == "no answer"


def test_completion_stops_at_non_numeric_score(spark):
    r = _rows(spark, [("a", None, None, "reply", None)])
    bad = dict(FULL, EmpathyScore="n/a")
    a = spark.createDataFrame([("a", "completion", None, 1, 200, _content(bad))], E.ANSWER_SCHEMA)
    out = E.apply_completion(r, a).first()
    assert out["SensitiveTopic"] == "No" and out["EmpathyScore"] is None and out["HelpfulnessScore"] is None


def test_translation_rules(spark):
    r = schema_conform(spark.createDataFrame([
        ("en", "EN", "Indeed", "text", "reply", None, None),
        ("de", "DE", "Glassdoor", "Der Text", "Die Antwort", None, None),
        ("never", "DE", "Glassdoor", "Der Text", "", None, None),
        ("labels", "DE", "kununu", "\n\nsalary rating: 3/5 ", "x", None, "done"),
    ], "ID string, Language string, Portal string, ReviewText string, Response string, "
       "ReviewTextEN string, ResponseEN string"))
    req = E.translation_requests(r)
    assert rows(req, "ID", "field") == [("de", "ResponseEN"), ("de", "ReviewTextEN"),
                                        ("never", "ReviewTextEN")]
    ans = spark.createDataFrame([
        ("de", "translation", "ReviewTextEN", 1, 200, "Der Text"),
        ("de", "translation", "ReviewTextEN", 2, 200, "The text is from the team"),
        ("de", "translation", "ResponseEN", 1, 200, "The reply of the team"),
        ("never", "translation", "ReviewTextEN", 1, 500, None),
        ("never", "translation", "ReviewTextEN", 2, 200, "Der Text"),
    ], E.ANSWER_SCHEMA).withColumn("lang", C.text_language(F.col("content")))
    out = {x["ID"]: x.asDict() for x in E.apply_translation(r, ans).collect()}
    assert out["en"]["ReviewTextEN"] == "text" and out["en"]["ResponseEN"] == "reply"
    assert out["de"]["ReviewTextEN"] == "The text is from the team"
    assert out["de"]["ResponseEN"] == "The reply of the team"
    assert out["never"]["DeveloperComment"] == "Check lang"
    assert out["labels"]["ReviewTextEN"] == "\n\nsalary rating: 3/5 "


def test_individuality_rubric(spark):
    block = "Vielen Dank fuer Ihre ausfuehrliche Bewertung"
    other = "Wir wuenschen Ihnen alles Gute fuer die Zukunft"
    df = schema_conform(spark.createDataFrame([
        ("blank", ""), ("leer", "(Leer)"), ("dup1", "same text"), ("dup2", "same text"),
        ("two", f"{block}\n{other}\nIndividuell"), ("two_b", f"{block}\n{other}\nAnders"),
        ("none", "Ganz eigener Text ohne Bausteine hier drin"),
    ], "ID string, Response string"))
    got = dict(rows(C.individuality_score(df), "ID", "individuality"))
    assert got == {"blank": 1.0, "leer": 1.0, "dup1": 1.0, "dup2": 1.0, "two": 4.0, "two_b": 4.0,
                   "none": 5.0}


def test_language_detection(spark):
    df = schema_conform(spark.createDataFrame([
        ("1", "Indeed", "Pros: the team and the work is good", "T"),
        ("2", "kununu", "\n\nsalary rating: 3/5 ", "Der Chef und die Kollegen"),
        ("3", "Glassdoor", "xyz", "abc"),
    ], "ID string, Portal string, ReviewText string, ReviewTitle string"))
    got = dict(rows(C.detect_language(df), "ID", "detected_lang"))
    assert got == {"1": "EN", "2": "DE", "3": "Other"}


def test_infer_replies_skips_ledger(spark):
    req = spark.createDataFrame([("a", "x"), ("b", "y")], "ID string, t string").select(
        "ID", F.lit("reply").alias("kind"), F.struct(F.col("t")).alias("request"))
    first = E.infer_replies(req, echo_client, partitions=2)
    assert first.count() == 2
    again = E.infer_replies(req, echo_client, ledger=first.filter(F.col("ID") == "a"))
    assert [r["ID"] for r in again.collect()] == ["b"]


def test_failed_calls_are_asked_again_and_counted_on(spark):
    req = E.reply_requests(schema_conform(spark.createDataFrame(
        [("a", "DE", "Text"), ("b", "DE", "Text")], "ID string, Language string, ReviewText string")))
    calls = E.with_request_hash(req).select("ID", "kind", F.lit(None).cast("string").alias("field"), "request_hash")
    ledger = (calls.filter("ID = 'a'").select("*", F.lit(1).alias("attempt"), F.lit(500).alias("status"), F.lit("x").alias("content"))
              .unionByName(calls.filter("ID = 'b'").select("*", F.lit(1).alias("attempt"), F.lit(201).alias("status"),
                                                           F.lit("y").alias("content"))))
    out = E.infer_replies(req, echo_client, ledger)
    assert rows(out, "ID", "attempt", "status") == [("a", 2, 200)]


def test_retrying_asks_only_what_failed():
    import pandas as pd

    seen = []

    def client(pdf):
        seen.append(list(pdf["ID"]))
        ok = (pdf["ID"] != "b") | (len(seen) > 2)
        return pd.DataFrame({"ID": pdf["ID"], "kind": "reply", "field": None, "request_hash": pdf["request_hash"],
                             "attempt": 1, "status": ok.map({True: 200, False: 429}), "content": "c"})

    waits = []
    out = E.retrying(client, 3, waits.append)(pd.DataFrame({"ID": ["a", "b"], "request_hash": ["1", "2"]}))
    assert seen == [["a", "b"], ["b"], ["b"]] and waits == [1, 2]
    assert list(zip(out["ID"], out["attempt"], out["status"])) == [("a", 1, 200), ("b", 1, 429), ("b", 2, 429), ("b", 3, 200)]


def test_system_message_is_part_of_the_request(spark):
    table = schema_conform(spark.createDataFrame([("a", "DE", "Text", "Re")], "ID string, Language string, ReviewText string, Response string"))
    for build in (E.reply_requests, E.completion_requests, E.translation_requests):
        hashes = {E.with_request_hash(build(table, s)).first().request_hash for s in (None, "one", "two")}
        assert len(hashes) == 3
    first = E.reply_requests(table, "Be kind").first().request.messages
    assert [(m.role, m.content) for m in first[:1]] == [("system", "Be kind")] and first[1].role == "user"


def test_answer_to_an_earlier_request_is_not_applied(spark):
    table = schema_conform(spark.createDataFrame(
        [("a", "DE", "Text", "OLD", "Regenerate")], "ID string, Language string, ReviewText string, Response string, ApprovalStatus string"))
    old = E.with_request_hash(E.reply_requests(table.withColumn("ApprovalStatus", F.lit(None).cast("string"))))
    ledger = old.select("ID", "kind", F.lit(None).cast("string").alias("field"), "request_hash", F.lit(1).alias("attempt"),
                        F.lit(200).alias("status"), F.lit('{"Response": "OLD"}').alias("content"))
    out = E.apply_reply(table, ledger, ASOF, with_outcome=True, requests=E.reply_requests(table))
    assert rows(out, "Response", "ApprovalStatus", "outcome") == [("OLD", "Regenerate", "no answer")]


def _ledger(requests, attempt, status, content):
    field = F.col("field") if "field" in requests.columns else F.lit(None).cast("string")
    return E.with_request_hash(requests).select("ID", "kind", field.alias("field"), "request_hash", F.lit(attempt).alias("attempt"),
                                                F.lit(status).alias("status"), F.lit(content).alias("content"))


def test_a_ledger_with_hashes_is_never_joined_by_id_alone(spark):
    """No requests are given: they are built from the rows."""
    table = schema_conform(spark.createDataFrame(
        [("a", "DE", "Text", "OLD", "Regenerate")], "ID string, Language string, ReviewText string, Response string, ApprovalStatus string"))
    stale = _ledger(E.reply_requests(table.withColumn("ApprovalStatus", F.lit(None).cast("string"))), 7, 200, '{"Response": "OLD"}')
    assert rows(E.apply_reply(table, stale, ASOF), "Response", "ApprovalStatus") == [("OLD", "Regenerate")]
    both = stale.unionByName(_ledger(E.reply_requests(table), 1, 200, '{"Response": "NEW"}'))
    assert rows(E.apply_reply(table, both, ASOF), "Response", "ApprovalStatus") == [("NEW", "Pending")]
    # the same messages under another system message are another request
    assert rows(E.apply_reply(table, both, ASOF, system="Be kind"), "Response") == [("OLD",)]
    done = schema_conform(spark.createDataFrame([("a", "Text", "now")], "ID string, ReviewText string, Response string"))
    old = _ledger(E.completion_requests(done.withColumn("Response", F.lit("before"))), 5, 200, '{"SensitiveTopic": "Yes"}')
    assert rows(E.apply_completion(done, old), "SensitiveTopic") == [(None,)]
    new = old.unionByName(_ledger(E.completion_requests(done), 1, 200, '{"SensitiveTopic": "No"}'))
    assert rows(E.apply_completion(done, new), "SensitiveTopic") == [("No",)]


def test_translation_of_an_older_text_is_not_stored(spark):
    table = schema_conform(spark.createDataFrame([("a", "DE", "Der Text", "Neue Antwort")],
                                                 "ID string, Language string, ReviewText string, Response string"))
    before = E.translation_requests(table.withColumn("Response", F.lit("Alte Antwort"))).filter("field = 'ResponseEN'")
    now = E.translation_requests(table).filter("field = 'ResponseEN'")
    for attempts in ((1, 1), (9, 1)):
        ledger = _ledger(before, attempts[0], 200, "This is the old reply of the team").unionByName(
            _ledger(now, attempts[1], 200, "This is the new reply of the team"))
        out = E.apply_translation(table, ledger.withColumn("lang", F.lit("EN")))
        assert rows(out, "ResponseEN", "DeveloperComment") == [("This is the new reply of the team", None)]
    # failures and used-up tries of the older request do not count either
    ledger = _ledger(before, 1, 500, None).unionByName(_ledger(before, 2, 200, "Alt"))
    out = E.apply_translation(table, ledger.withColumn("lang", F.lit("DE")))
    assert rows(out, "ResponseEN", "DeveloperComment") == [(None, None)]


def test_request_errors_lists_only_what_never_succeeded(spark):
    table = schema_conform(spark.createDataFrame([(i,) for i in "abc"], "ID string"))
    data = [("a", "reply", "h1", 1, 500), ("a", "reply", "h1", 2, 200), ("b", "reply", "h1", 1, 200), ("b", "reply", "h2", 1, 429),
            ("c", "translation", "h1", 1, 500), ("c", "translation", "h1", 2, 503), ("x", "reply", "h1", 1, 500)]
    ledger = spark.createDataFrame([(i, k, None, h, n, s, None) for i, k, h, n, s in data], E.LEDGER_SCHEMA)
    assert rows(E.request_errors(table, ledger)) == [("b", "reply", 429, "429"), ("c", "translation", 503, "503(translation)")]


def test_open_requests_compile(spark, capfd):
    """Requests over detected languages stay under the size that Spark can compile."""
    from conftest import SF001
    from reviewops.plans import QUERIES

    for key in ("infer_replies", "regenerate_twice", "apply_reply_by_request"):
        assert QUERIES[key](spark, SF001).count() > 0
    err = capfd.readouterr().err
    assert "grows beyond 64 KB" not in err


def test_given_answers_are_those_of_the_request(spark):
    table = schema_conform(spark.createDataFrame([("a", "DE", "T"), ("b", "DE", "T")], "ID string, Language string, ReviewText string"))
    req = E.reply_requests(table)
    ledger = _ledger(req, 1, 200, "first").unionByName(_ledger(req, 2, 200, "second")).unionByName(_ledger(req.filter("ID = 'a'"), 3, 500, "x"))
    ledger = ledger.unionByName(_ledger(E.reply_requests(table, "other"), 4, 200, "other"))
    assert rows(E.given_answers(req, ledger), "ID", "attempt", "content") == [("a", 2, "second"), ("b", 2, "second")]
    assert E.open_requests(req, ledger).count() == 0 and E.open_requests(E.reply_requests(table, "new"), ledger).count() == 2
