"""Registered key joins, merges, dedupe and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as A
from ..operators import merge as M
from ..sources.fixtures import merge_incoming, merge_target
from .oracle import COLS, with_reviews
from .registry import register

TARGET = "target AS (SELECT * FROM reviews WHERE ReviewDate < DATE '2024-01-22')"
INCOMING = ("incoming AS (SELECT * REPLACE (OverallSatisfaction + 10 AS OverallSatisfaction)"
            " FROM reviews WHERE ReviewDate >= DATE '2024-01-08')")


def _sql(body: str) -> str:
    return with_reviews(body, TARGET, INCOMING)


@register("existing_keys", _sql("SELECT * FROM incoming WHERE ID IN (SELECT ID FROM target)"))
def q_existing_keys(spark, sf):
    return M.existing_keys(merge_incoming(spark, sf), merge_target(spark, sf))


@register("new_keys", _sql("SELECT * FROM incoming WHERE ID NOT IN (SELECT ID FROM target)"))
def q_new_keys(spark, sf):
    return M.new_keys(merge_incoming(spark, sf), merge_target(spark, sf))


@register("merge_insert", _sql(
    "SELECT * FROM target UNION ALL SELECT * FROM incoming WHERE ID NOT IN (SELECT ID FROM target)"))
def q_merge_insert(spark, sf):
    return M.merge_insert(merge_target(spark, sf), merge_incoming(spark, sf), stored=True)


@register("merge_update", _sql(
    "SELECT * FROM target WHERE ID NOT IN (SELECT ID FROM incoming)"
    " UNION ALL SELECT * FROM incoming WHERE ID IN (SELECT ID FROM target)"))
def q_merge_update(spark, sf):
    return M.merge_update(merge_target(spark, sf), merge_incoming(spark, sf), stored=True)


@register("merge_upsert", _sql(
    "SELECT * FROM target WHERE ID NOT IN (SELECT ID FROM incoming) UNION ALL SELECT * FROM incoming"))
def q_merge_upsert(spark, sf):
    return M.merge_upsert(merge_target(spark, sf), merge_incoming(spark, sf), stored=True)


@register("merge_noop", _sql("SELECT * FROM target"))
def q_merge_noop(spark, sf):
    return M.merge(merge_target(spark, sf), merge_incoming(spark, sf), False, False)


_FEED = ("feed AS (SELECT *, 0 AS seq FROM target UNION ALL SELECT *, 1 AS seq FROM incoming)")


@register("dedupe_incoming", with_reviews(
    f"SELECT {COLS} FROM (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY seq) AS rn"
    " FROM feed) WHERE rn = 1", TARGET, INCOMING, _FEED))
def q_dedupe_incoming(spark, sf):
    feed = (merge_target(spark, sf).withColumn("seq", F.lit(0))
            .unionByName(merge_incoming(spark, sf).withColumn("seq", F.lit(1))))
    return M.dedupe_incoming(feed, "seq")


@register("duplicate_ids", _sql(
    "SELECT ID, count(ID) AS id_count FROM (SELECT ID FROM target UNION ALL SELECT ID FROM incoming)"
    " GROUP BY ID HAVING count(ID) > 1"))
def q_duplicate_ids(spark, sf):
    both = merge_target(spark, sf).unionByName(merge_incoming(spark, sf))
    return A.duplicate_ids(both)


@register("status_summary", _sql(
    "SELECT Portal, ApprovalStatus, count(*) AS reviews,"
    " count(*) FILTER (WHERE Response = '' OR Response IS NULL) AS blank_replies,"
    " count(*) FILTER (WHERE OnlineYesNo = 'Yes') AS online,"
    " count(*) FILTER (WHERE OnlineYesNo = 'No') AS offline,"
    " count(*) FILTER (WHERE OnlineYesNo IS NULL) AS online_unknown,"
    " count(*) FILTER (WHERE ResponsePostedYesNo = 'Yes') AS posted"
    " FROM (SELECT * FROM target WHERE ID NOT IN (SELECT ID FROM incoming) UNION ALL SELECT * FROM incoming)"
    " GROUP BY Portal, ApprovalStatus"))
def q_status_summary(spark, sf):
    return A.status_summary(M.merge_upsert(merge_target(spark, sf), merge_incoming(spark, sf), stored=True))


_DIFF_COLS = [c.strip() for c in COLS.split(",") if c.strip() != "ID"]
_CHANGED = "concat_ws(',', " + ", ".join(
    f"CASE WHEN b.{c} IS DISTINCT FROM a.{c} THEN '{c}' END" for c in _DIFF_COLS) + ")"


@register("debug_snapshot", _sql(
    "SELECT ID, status, changed_columns FROM ("
    " SELECT coalesce(b.ID, a.ID) AS ID,"
    "  CASE WHEN b.ID IS NULL THEN 'added' WHEN a.ID IS NULL THEN 'removed'"
    f"   WHEN {_CHANGED} <> '' THEN 'changed' END AS status,"
    f"  CASE WHEN a.ID IS NOT NULL AND b.ID IS NOT NULL THEN {_CHANGED} END AS changed_columns"
    " FROM target b FULL OUTER JOIN (SELECT * FROM target WHERE ID NOT IN (SELECT ID FROM incoming)"
    "  UNION ALL SELECT * FROM incoming) a ON a.ID = b.ID) WHERE status IS NOT NULL"))
def q_debug_snapshot(spark, sf):
    before = merge_target(spark, sf)
    after = M.merge_upsert(before, merge_incoming(spark, sf), stored=True)
    return A.row_diff(before, after)
