"""Registered sink and stream round trips: the output is read back and must
equal its batch / table counterpart."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from ..operators import merge as M
from ..operators import worklists as W
from ..schema import FIXTURE_ASOF, empty_reviews
from ..session import scratch_path
from ..sinks.table import (compact, csv_backup, dupes_report, read_csv_backup, read_table, run_log, table_patch_sink,
                           table_replace_sink, table_sink)
from ..sources.fixtures import landed_dir, merge_incoming, merge_target, reviews
from ..streaming.ingest import stream_ingest
from .oracle import with_reviews
from .q_ingest import SINCE
from .q_merge import INCOMING, TARGET
from .registry import ORACLE
from .registry import register


def _fresh(spark, kind: str) -> str:
    return scratch_path(spark, kind, uuid.uuid4().hex)


def q_stream_ingest(spark, sf):
    """Landed pages streamed (``availableNow``) into a new table; the table
    read back equals the batch extract."""
    root = _fresh(spark, "stream-tables")
    q = stream_ingest(spark, landed_dir(spark, sf), root, SINCE, FIXTURE_ASOF,
                      checkpoint=_fresh(spark, "stream-checkpoints"))
    q.awaitTermination()
    return read_table(spark, root)


register("stream_ingest", ORACLE["extract_new_reviews"])(q_stream_ingest)


@register("csv_backup", ORACLE["table_scan"])
def q_csv_backup(spark, sf):
    """The whole table written as a CSV backup and read back (quotes, newlines,
    edge spaces, NULL vs empty string all survive)."""
    path = csv_backup(reviews(spark, sf), _fresh(spark, "backups"),
                      _dt.datetime.combine(FIXTURE_ASOF, _dt.time(7, 0)))
    return read_csv_backup(spark, path)


@register("table_sink", ORACLE["merge_insert"])
def q_table_sink(spark, sf):
    """New rows appended to a written table, read back."""
    root = _fresh(spark, "tables")
    table_replace_sink(merge_target(spark, sf), root)
    table_sink(M.new_keys(merge_incoming(spark, sf), read_table(spark, root)), root)
    return read_table(spark, root)


@register("table_replace_sink", ORACLE["merge_upsert"])
def q_table_replace_sink(spark, sf):
    """A second, clustered version replaces the first; readers see the second only."""
    root = _fresh(spark, "tables")
    table_replace_sink(merge_target(spark, sf), root)
    table_replace_sink(M.merge_upsert(read_table(spark, root), merge_incoming(spark, sf), stored=True), root, buckets=4)
    return read_table(spark, root)


@register("dupes_report", with_reviews(
    "SELECT ID, count(ID) AS id_count, DATE '2024-01-31' AS asof FROM (SELECT ID FROM target UNION ALL"
    " SELECT ID FROM incoming) GROUP BY ID HAVING count(ID) > 1", TARGET, INCOMING))
def q_dupes_report(spark, sf):
    """The written duplicate-key report, read back."""
    path = _fresh(spark, "reports")
    both = merge_target(spark, sf).unionByName(merge_incoming(spark, sf))
    dupes_report(both, path, FIXTURE_ASOF)
    return spark.read.schema("ID string, id_count long, asof date").option("header", "true").csv(path)


@register("run_log", with_reviews(
    "SELECT TIMESTAMP '2024-01-31 07:00:00' AS ts, stage, ID, reason FROM ("
    " SELECT 'regenerate' AS stage, ID, 'status ' || ApprovalStatus AS reason FROM reviews"
    " WHERE ApprovalStatus = 'Regenerate' UNION ALL SELECT 'completion', ID, 'incomplete' FROM reviews"
    " WHERE NOT (Response = '' OR Response IS NULL) AND SensitiveTopic IS NULL)"))
def q_run_log(spark, sf):
    """Two stages' events appended to one log, read back."""
    path, at = _fresh(spark, "logs"), _dt.datetime.combine(FIXTURE_ASOF, _dt.time(7, 0))
    r = reviews(spark, sf)
    run_log(W.regenerate_rows(r).select("ID", F.concat(F.lit("status "), "ApprovalStatus").alias("reason")), path, "regenerate", at)
    run_log(W.incomplete_rows(r).select("ID", F.lit("incomplete").alias("reason")), path, "completion", at)
    return spark.read.parquet(path)


@register("schema_clone", ORACLE["table_scan"])
def q_schema_clone(spark, sf):
    """An empty clone takes the whole table, column by column."""
    return empty_reviews(spark).unionByName(reviews(spark, sf))


@register("duplicate_key_rejects", with_reviews(
    "SELECT ID, count(*) AS n FROM (SELECT ID FROM target UNION ALL SELECT ID FROM incoming"
    " UNION ALL SELECT NULL FROM incoming WHERE Location IS NULL) GROUP BY ID HAVING count(*) > 1 OR ID IS NULL",
    TARGET, INCOMING))
def q_duplicate_key_rejects(spark, sf):
    """The keys for which a merge refuses a batch: repeated ones and NULL."""
    incoming = merge_incoming(spark, sf)
    batch = (merge_target(spark, sf).select("ID").unionByName(incoming.select("ID"))
             .unionByName(incoming.filter("Location IS NULL").select(F.lit(None).cast("string").alias("ID"))))
    return M.duplicate_keys(batch)


# Three patches: all incoming rows, then every second, then every third of them.
_NUMBER = "CAST(split_part(ID, '-', 2) AS BIGINT)"


def _patched(extra: str = "") -> str:
    step = f"CASE {extra} WHEN {_NUMBER} % 3 = 0 THEN 3 WHEN {_NUMBER} % 2 = 0 THEN 2 ELSE 1 END"
    return with_reviews(
        "SELECT * FROM target WHERE ID NOT IN (SELECT ID FROM incoming)"
        f" UNION ALL SELECT * REPLACE (OverallSatisfaction + {step} AS OverallSatisfaction) FROM incoming", TARGET, INCOMING)


def _step(rows, every: int):
    n = F.split_part("ID", F.lit("-"), F.lit(2)).cast("long")
    return rows.filter(n % every == 0).withColumn("OverallSatisfaction", F.col("OverallSatisfaction") + every)


def _patched_table(spark, sf):
    root = _fresh(spark, "tables")
    table_replace_sink(merge_target(spark, sf), root)
    for every in (1, 2, 3):
        table_patch_sink(_step(merge_incoming(spark, sf), every), root)
    return root


@register("merge_on_read", _patched())
def q_merge_on_read(spark, sf):
    """A table of one version and three patches, read: the newest patch row of an ID, else the version's."""
    return read_table(spark, _patched_table(spark, sf))


@register("merge_compacted", _patched(f"WHEN {_NUMBER} % 5 = 0 THEN 5"))
def q_merge_compacted(spark, sf):
    """The same table compacted into a version clustered by ID, patched once more, and read."""
    root = _patched_table(spark, sf)
    compact(spark, root, buckets=spark.sparkContext.defaultParallelism)
    table_patch_sink(_step(merge_incoming(spark, sf), 5), root)
    return read_table(spark, root)
