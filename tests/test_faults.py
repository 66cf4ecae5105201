"""Reference faults and how each is handled."""
import datetime as dt
import gzip
import json
import os

from pyspark.sql import functions as F

from conftest import rows
from reviewops.operators import enrich as E
from reviewops.operators import worklists as W
from reviewops.operators.merge import schema_conform
from reviewops.sources.feed import REVIEW_STRUCT
from reviewops.sources.usage import usage_report_scan, usage_window


def _t(spark, data, schema):
    return schema_conform(spark.createDataFrame(data, schema))


def test_d3_queue_carries_id_and_d4_precedence(spark):
    t = _t(spark, [("a", "No", "Yes", "Approved"), ("b", "Yes", "No", "ApplyNewResponse"),
                   ("c", "Yes", "Yes", "Approved"), ("d", None, None, None)],
           "ID string, ResponsePostedYesNo string, OnlineYesNo string, ApprovalStatus string")
    q = W.posting_queue(t)
    assert q.columns == ["ID", "Link", "Response"]
    assert rows(q, "ID") == [("a",), ("b",)]
    marked = W.mark_posted(t, q)
    assert rows(marked, "ID", "ResponsePostedYesNo") == [("a", "Yes"), ("b", "Yes"), ("c", "Yes"),
                                                         ("d", None)]


def test_d5_oldest_n_without_online_filter(spark):
    t = _t(spark, [("a", dt.date(2024, 1, 1), "No"), ("b", dt.date(2024, 1, 2), "Yes"),
                   ("c", None, "Yes")], "ID string, RefreshDate date, OnlineYesNo string")
    assert rows(W.refresh_oldest_n(t, 2), "ID") == [("a",), ("c",)]
    assert rows(W.refresh_oldest_n(t, 2, online_only=True), "ID") == [("b",), ("c",)]


def test_d14_top_n_ties_broken_by_id(spark):
    t = _t(spark, [(i, "Regenerate") for i in ("z", "b", "m", "a")], "ID string, ApprovalStatus string")
    assert rows(W.regenerate_rows(t, 2), "ID") == [("a",), ("b",)]


def test_d17_current_job_flag_must_be_boolean(spark):
    df = spark.createDataFrame([('{"id": "1", "is_current_job": "false"}',),
                                ('{"id": "2", "is_current_job": false}',)], "raw string")
    got = rows(df.select(F.from_json("raw", REVIEW_STRUCT).alias("r")).select("r.id", "r.is_current_job"))
    assert ("2", False) in got and ("1", True) not in got


def test_d11_translation_attempts_bounded(spark):
    r = _t(spark, [("x", "DE", "Glassdoor", "Der Text", "")],
           "ID string, Language string, Portal string, ReviewText string, Response string")
    ans = spark.createDataFrame(
        [("x", "translation", "ReviewTextEN", a, 200, "The text of the team" if a > 3 else "Der Text") for a in range(1, 6)],
        E.ANSWER_SCHEMA).withColumn("lang", F.when(F.col("attempt") > 3, "EN").otherwise("DE"))
    out = E.apply_translation(r, ans).first()
    assert out["ReviewTextEN"] is None  # answers beyond the bound are ignored


def test_usage_report_gzip_json(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "report.json.gz")
    recs = [{"event_id": i, "ts": f"2024-05-{1 + i:02d}T00:00:00", "user_id": 1, "event_type": "q",
             "value": 1.0} for i in range(5)]
    with gzip.open(path, "wt") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    df = usage_report_scan(spark, path)
    got = usage_window(df, dt.datetime(2024, 5, 2), dt.datetime(2024, 5, 4))
    assert rows(got, "event_id") == [(1,), (2,)]


def test_cluster_without_shared_checkpoint_folder_is_refused():
    """Off local mode an unset ``spark.checkpoint.dir`` is an error: a
    machine-local temp folder would not survive executor loss."""
    import pytest

    from reviewops.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

        def set(self, key, value):
            raise AssertionError("must not set a local folder on a cluster")

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="shared storage"):
        ensure_checkpoint_dir(Session())
