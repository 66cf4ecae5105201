"""Work-list selections over the review table.

Each is a filter (pushed into the Parquet scan) with at most a top-n; the
predicates keep the reference's SQL shape, including its NULL behaviour and its
operator precedence.  No operator sorts a whole result: order is only imposed
where a top-n needs it (``TakeOrderedAndProject``: per-partition top-n, then a
merge of n rows per partition).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.text import blank_or_null


def _c(n: str) -> Column:
    return F.col(n)


def _online_or_unknown() -> Column:
    return _c("OnlineYesNo").isNull() | (_c("OnlineYesNo") == "Yes")


def unanswered(table: DataFrame, since: _dt.date | None = None) -> DataFrame:
    """``unanswered_since`` / ``unanswered_all``: blank reply (optionally newer than
    ``since``) or marked for regeneration."""
    cond = blank_or_null(_c("Response"))
    if since is not None:
        cond = cond & (_c("ReviewDate") >= F.lit(since))
    return table.filter(cond | (_c("ApprovalStatus") == "Regenerate"))


def top_n(df: DataFrame, n: int | None, *order: Column) -> DataFrame:
    """``TOP n``; ``ID`` breaks ties so the pick is repeatable.  ``None`` means all
    rows, 0 none."""
    if n is None:
        return df
    return df.orderBy(*order, F.asc("ID")).limit(n)


def incomplete_rows(table: DataFrame, count: int | None = None) -> DataFrame:
    cond = ~blank_or_null(_c("Response")) & _c("SensitiveTopic").isNull()
    return top_n(table.filter(cond), count)


def regenerate_rows(table: DataFrame, count: int | None = None) -> DataFrame:
    return top_n(table.filter(_c("ApprovalStatus") == "Regenerate"), count)


def refresh_new(table: DataFrame, asof: _dt.date,
                delay: int = S.NEW_REVIEW_REFRESH_DELAY) -> DataFrame:
    return table.filter((_c("ReviewDate") == F.date_sub(F.lit(asof), delay)) & _online_or_unknown())


def _sensitive_cond(asof: _dt.date, interval: int, frequency: int) -> Column:
    return ((_c("ReviewDate") >= F.date_sub(F.lit(asof), interval))
            & (_c("RefreshDate") <= F.date_sub(F.lit(asof), frequency))
            & (_c("SensitiveTopic") == "Yes") & _online_or_unknown())


def refresh_sensitive(table: DataFrame, asof: _dt.date,
                      interval: int = S.SENSITIVE_REVIEW_REFRESH_INTERVAL,
                      frequency: int = S.SENSITIVE_REVIEW_REFRESH_FREQUENCY) -> DataFrame:
    return table.filter(_sensitive_cond(asof, interval, frequency))


def min_refresh_date(table: DataFrame) -> DataFrame:
    """Scalar MIN over all rows (NULLs skipped), as a one-row frame."""
    return table.agg(F.min("RefreshDate").alias("min_refresh_date"))


def refresh_oldest_day(table: DataFrame) -> DataFrame:
    """Rows on the oldest RefreshDate; the MIN runs over all rows (a scalar
    subquery: partial min per task, one value), the online test only here."""
    oldest = table.agg(F.min("RefreshDate")).scalar()
    return table.filter((_c("RefreshDate") == oldest) & _online_or_unknown())


def refresh_oldest_n(table: DataFrame, n: int = S.OLD_REVIEW_REFRESH_COUNT,
                     online_only: bool = False) -> DataFrame:
    """``TOP n ... ORDER BY RefreshDate`` (NULL first, as the source database sorts).
    The reference has no online test in this branch; ``online_only`` adds one."""
    df = table.filter(_online_or_unknown()) if online_only else table
    return top_n(df, n, F.asc_nulls_first("RefreshDate"))


def posting_queue(table: DataFrame) -> DataFrame:
    """Approved, online, not yet posted -- or ``ApplyNewResponse`` regardless of
    the other tests (AND binds before OR).  Carries ``ID`` so posting can be
    merged back."""
    cond = (((_c("ResponsePostedYesNo") == "No") & (_c("OnlineYesNo") == "Yes")
             & (_c("ApprovalStatus") == "Approved"))
            | (_c("ApprovalStatus") == "ApplyNewResponse"))
    return table.filter(cond).select("ID", "Link", "Response")


def queue_projection(table: DataFrame) -> DataFrame:
    return table.select("ID", "Link", "Response")


def translate_candidates(table: DataFrame, num: int | None = None) -> DataFrame:
    """Missing an EN column while a reply exists (``''`` counts as present);
    newest first when a batch size is given."""
    cond = ((_c("ReviewTextEN").isNull() | _c("ResponseEN").isNull())
            & _c("Response").isNotNull())
    return top_n(table.filter(cond), num, F.desc_nulls_last("ReviewDate"))


# ---------------------------------------------------------------------------
# Refresh work-list.  Two scans of wide rows, each behind a filter that reaches the
# files: the date and flag conditions of the new and the sensitive rows, and, for the oldest
# rows, the latest date among them.  The oldest-n pick itself scans ID and date alone.

# IDs of an oldest-n pick that are broadcast at most; a larger n joins plainly.
BROADCAST_IDS = 100_000

BUCKETS = ("new", "sensitive", "oldest")


def _dated_conds(asof: _dt.date) -> tuple[Column, Column]:
    new = (_c("ReviewDate") == F.date_sub(F.lit(asof), S.NEW_REVIEW_REFRESH_DELAY)) & _online_or_unknown()
    return new, _sensitive_cond(asof, S.SENSITIVE_REVIEW_REFRESH_INTERVAL, S.SENSITIVE_REVIEW_REFRESH_FREQUENCY)


def _oldest(table: DataFrame, oldest_count: int) -> DataFrame:
    if oldest_count < 0:
        return refresh_oldest_day(table)
    picked = refresh_oldest_n(table.select("ID", "RefreshDate"), oldest_count)
    latest = picked.agg(F.max("RefreshDate")).scalar()
    ids = picked.select("ID")
    if oldest_count <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return table.filter(_c("RefreshDate").isNull() | (_c("RefreshDate") <= latest)).join(ids, "ID", "left_semi")


def refresh_worklist(table: DataFrame, asof: _dt.date,
                     oldest_count: int = S.OLD_REVIEW_REFRESH_COUNT) -> DataFrame:
    """UNION ALL of new + sensitive + oldest, overlaps kept, with a ``bucket``."""
    new, sens = _dated_conds(asof)
    buckets = F.filter(F.array(F.when(new, F.lit("new")), F.when(sens, F.lit("sensitive"))), lambda b: b.isNotNull())
    cols = [_c(c) for c in S.COLUMN_NAMES]
    dated = table.filter(new | sens).select(*cols, F.explode(buckets).alias("bucket"))
    return dated.unionByName(_oldest(table, oldest_count).select(*cols, F.lit("oldest").alias("bucket")))


def refresh_worklist_distinct(table: DataFrame, asof: _dt.date,
                              oldest_count: int = S.OLD_REVIEW_REFRESH_COUNT) -> DataFrame:
    """One row per ID (the union above would put an ID twice into a merge whose
    key must be unique); bucket priority new > sensitive > oldest."""
    new, sens = _dated_conds(asof)
    cols = [_c(c) for c in S.COLUMN_NAMES]
    dated = table.filter(new | sens).select(*cols, F.when(new, "new").otherwise("sensitive").alias("bucket"))
    rest = _oldest(table, oldest_count).filter(~F.coalesce(new | sens, F.lit(False)))
    return dated.unionByName(rest.select(*cols, F.lit("oldest").alias("bucket")))


def mark_posted(table: DataFrame, posted: DataFrame, posted_rows: int | None = None) -> DataFrame:
    """Set ``ResponsePostedYesNo = 'Yes'`` on every table row whose ID was
    posted; all other rows unchanged.  Full rows come from the table, so a
    narrow posting frame can never replace a wide row.  One left join against
    the distinct posted IDs, which are broadcast where their measured number
    (``posted_rows``) is within the bound."""
    ids = posted.select("ID").distinct().withColumn("_posted", F.lit(True))
    if posted_rows is not None and posted_rows <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    j = table.join(ids, "ID", "left")
    return j.select(*[F.when(_c("_posted"), F.lit("Yes")).otherwise(_c(c)).alias(c)
                      if c == "ResponsePostedYesNo" else _c(c) for c in table.columns])
