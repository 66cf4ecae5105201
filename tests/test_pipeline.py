"""The daily batch end to end on sf0.001 (versions, lineage cut by writes)."""
import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF001, rows
from reviewops.operators import enrich as E
from reviewops.operators import worklists as W
from reviewops.operators import merge as M
from reviewops.operators.merge import schema_conform
from reviewops.plans.pipeline import completion_stage, run_batch, translation_stage
from reviewops.sinks import table as T
from reviewops.sources.fixtures import feed_pages, model_answers, reviews, translation_answers

ASOF = dt.date(2024, 1, 31)


def test_run_batch(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "table")
    base = reviews(spark, SF001)
    T.table_replace_sink(base, root)
    before = T.read_table(spark, root)
    n_unanswered = W.unanswered(before).filter(F.col("ApprovalStatus").isNull()).count()
    answers = model_answers(spark, SF001)
    translations = translation_answers(
        spark, SF001, E.translation_requests(W.translate_candidates(before)))
    out = run_batch(spark, root, answers, translations, ASOF,
                    backup_dir=os.path.join(tmpdir_path, "backups"),
                    dupes_path=os.path.join(tmpdir_path, "dupes"),
                    log_path=os.path.join(tmpdir_path, "log"))
    # one write for all stages; no row that a selection finds is left out
    assert out["version"] == 2 and "errors" not in out
    assert out["reply"] == W.unanswered(before).count()
    assert out["translate"] > 20
    after = T.read_table(spark, root)
    assert after.count() == base.count()
    assert after.select("ID").distinct().count() == base.count()
    pending = after.filter(F.col("ApprovalStatus") == "Pending").count()
    assert pending > before.filter(F.col("ApprovalStatus") == "Pending").count()
    assert n_unanswered > 0
    assert os.path.exists(os.path.join(out["backup"], "_SUCCESS"))
    log = spark.read.parquet(os.path.join(tmpdir_path, "log"))
    reasons = {r["reason"] for r in log.select("reason").distinct().collect()}
    assert reasons <= {"request failed", "unparsable answer", "missing key"} and reasons


def test_one_failing_stage_does_not_end_the_batch(spark, tmpdir_path):
    root, log = (os.path.join(tmpdir_path, x) for x in ("table", "log"))
    T.table_replace_sink(reviews(spark, SF001), root)
    broken = model_answers(spark, SF001).withColumn("status", F.raise_error(F.lit("ledger unreadable")).cast("int"))
    landed = feed_pages(spark, SF001)
    out = run_batch(spark, root, broken, None, ASOF, log_path=log, landed=landed, since=dt.datetime(2024, 1, 10))
    assert set(out["errors"]) == {"reply", "regenerate", "completion"} and out["ingest"] > 0
    assert T.read_table(spark, root).count() == 200 + out["ingest"]
    assert "stage failed" in {r.reason[:12] for r in spark.read.parquet(log).collect()}


def test_translation_stage_does_not_store_the_language(spark):
    table = reviews(spark, SF001)
    none = spark.createDataFrame([], E.ANSWER_SCHEMA)
    out = translation_stage(table, none)
    want = table.join(out.select("ID"), "ID", "left_semi")
    assert rows(out, "ID", "Language") == rows(want, "ID", "Language")
    assert out.filter("Language IS NULL").count() > 0
    assert translation_stage(table, none, 0).count() == 0


def test_completion_stage_fills_the_language_with_the_place_as_fallback(spark):
    table = schema_conform(spark.createDataFrame(
        [("a", "Indeed", "Super", "Top", "Bonn", "Danke"), ("b", "Indeed", "Super", "Top", None, "Danke")],
        "ID string, Portal string, ReviewTitle string, ReviewText string, Location string, Response string"))
    places = spark.createDataFrame([("Bonn", "DE")], "Location string, lang string")
    out = completion_stage(table, spark.createDataFrame([], E.ANSWER_SCHEMA), places=places)
    assert {r.ID: r.Language for r in out.collect()} == {"a": "DE", "b": "OTHER"}


def test_merge_of_a_measured_batch_shuffles_no_table_row(spark, tmpdir_path):
    """The final plan: no exchange carries ``ReviewText`` of the table, even with
    the planner's own broadcasts switched off."""
    root = os.path.join(tmpdir_path, "table")
    T.table_replace_sink(reviews(spark, SF001), root)
    table = T.read_table(spark, root)
    batch = table.limit(20).checkpoint()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for merge in (M.merge_update, M.merge_upsert):
            df = merge(table, batch, validate=None, **M.measured(batch))
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            tree = plan[plan.index("Final Plan"):plan.index("Initial Plan")] if "Initial Plan" in plan else plan
            shuffles = [x for x in tree.splitlines() if "Exchange hashpartitioning" in x]
            assert "BroadcastHashJoin" in tree
            assert not shuffles or merge is M.merge_update
            wide = [k for k, x in enumerate(tree.splitlines()) if "Exchange hashpartitioning" in x
                    and "ReviewText" in " ".join(tree.splitlines()[k + 1:k + 3]) and "version=" in " ".join(tree.splitlines()[k:k + 6])]
            assert not wide
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_batch_without_since_takes_whole_feeds(spark, tmpdir_path):
    roots = [os.path.join(tmpdir_path, x) for x in ("none", "min")]
    out = []
    for root, since in zip(roots, (None, dt.datetime(1900, 1, 1))):
        T.table_replace_sink(reviews(spark, SF001), root)
        out.append(run_batch(spark, root, asof=ASOF, landed=feed_pages(spark, SF001), since=since))
    assert "errors" not in out[0] and out[0]["ingest"] == out[1]["ingest"] > 0


def test_batch_does_not_close_a_regeneration_with_an_old_answer(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "table")
    table = schema_conform(spark.createDataFrame(
        [("a", "DE", "Indeed", "Text", "OLD", "Regenerate")],
        "ID string, Language string, Portal string, ReviewText string, Response string, ApprovalStatus string"))
    T.table_replace_sink(table, root)
    first = E.with_request_hash(E.reply_requests(table.withColumn("ApprovalStatus", F.lit(None).cast("string"))))
    ledger = first.select("ID", "kind", F.lit(None).cast("string").alias("field"), "request_hash", F.lit(1).alias("attempt"),
                          F.lit(200).alias("status"), F.lit('{"Response": "OLD"}').alias("content"))
    out = run_batch(spark, root, ledger, asof=ASOF)
    assert "errors" not in out
    assert rows(T.read_table(spark, root), "Response", "ApprovalStatus") == [("OLD", "Regenerate")]
