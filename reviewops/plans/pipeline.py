"""The daily batch as a chain of DataFrame transforms.

Stages, each over the table as the stages before left it:

1. ingest: landed feed pages -> new reviews
2. refresh: refresh work-list -> fetched pages applied
3. reply: unanswered -> language filled -> answers applied
4. regenerate: rows still marked ``Regenerate`` -> answers applied
5. completion: incomplete rows -> language filled -> answers applied
6. translation: rows missing an EN column -> verified translations applied
7. audit: CSV backup and duplicate-key report

A stage whose input is not given is skipped.  Every stage works on all rows that
its selection finds; batch sizes and the look-back are arguments.  A stage's
rows are staged with ``DataFrame.checkpoint()`` (files under the shared
``spark.checkpoint.dir``), counted, and laid over the table as a *patch*: the
next stage reads the table without the patched IDs plus the patch, which is a
broadcast anti join while the patch is small, so the table is only scanned.
The table is written once, at the end.  A stage that fails is logged, leaves no
rows, and the batch goes on.

Model answers come from the answer ledger (``infer_replies`` appends to it);
the pipeline itself makes no remote call.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import classify as C
from ..operators import enrich as E
from ..operators import ingest as I
from ..operators import merge as M
from ..operators import refresh as R
from ..operators import worklists as W
from ..sinks.table import csv_backup, dupes_report, read_table, run_log, table_patch_sink, table_replace_sink


def _language_known(rows: DataFrame, places: DataFrame | None) -> DataFrame:
    return C.fill_language(C.detect_language(rows, places)).drop("detected_lang")


def ingest_stage(table: DataFrame, landed: DataFrame, since: _dt.datetime | None, asof: _dt.date) -> DataFrame:
    """``since``: where a feed's take-while ends (``None``: nowhere)."""
    return M.new_keys(I.extract_landed(landed, since or _dt.datetime.min, asof), table.select("ID"))


def refresh_stage(table: DataFrame, fetches: DataFrame, asof: _dt.date,
                  pages: dict[str, R.PortalPage] = R.PORTAL_PAGES,
                  oldest_count: int = S.OLD_REVIEW_REFRESH_COUNT) -> DataFrame:
    rows = W.refresh_worklist_distinct(table, asof, oldest_count).drop("bucket")
    return R.apply_refresh(rows, fetches, asof, pages)


# The stages below apply an answer only to the request that the rows make now, if the
# ledger has request hashes (see ``enrich``).  Rows with a language found here are
# checkpointed first: the finding is much code, and the requests are built from it again.

def reply_stage(table: DataFrame, answers: DataFrame, asof: _dt.date, lookback_days: int | None = None,
                with_outcome: bool = False, places: DataFrame | None = None, system: str | None = None) -> DataFrame:
    """``lookback_days``: how old an unanswered review may be (``None``: any age)."""
    since = None if lookback_days is None else asof - _dt.timedelta(days=lookback_days)
    rows = _language_known(W.unanswered(table, since=since), places).checkpoint()
    return E.apply_reply(rows, answers, asof, with_outcome=with_outcome, system=system)


def regenerate_stage(table: DataFrame, answers: DataFrame, asof: _dt.date, n: int | None = None,
                     system: str | None = None) -> DataFrame:
    return E.apply_reply(W.regenerate_rows(table, n), answers, asof, system=system)


def completion_stage(table: DataFrame, answers: DataFrame, n: int | None = None,
                     places: DataFrame | None = None, system: str | None = None) -> DataFrame:
    """Completion answers applied; then rows still without a language get one."""
    return _language_known(E.apply_completion(W.incomplete_rows(table, n), answers, system=system), places)


def translation_stage(table: DataFrame, translations: DataFrame, n: int | None = None,
                      places: DataFrame | None = None, system: str | None = None) -> DataFrame:
    """The language found here only decides what is translated; it is not stored."""
    rows = W.translate_candidates(table, n)
    known = _language_known(rows.withColumn("_stored", F.col("Language")), places).checkpoint()
    verified = translations.withColumn("lang", C.text_language(F.col("content")))
    out = E.apply_translation(known, verified, system=system)
    return out.withColumn("Language", F.col("_stored")).select(*table.columns)


def run_batch(spark: SparkSession, table_root: str, answers: DataFrame | None = None,
              translations: DataFrame | None = None, asof: _dt.date | None = None,
              backup_dir: str | None = None, dupes_path: str | None = None,
              at: _dt.datetime | None = None, log_path: str | None = None, *,
              landed: DataFrame | None = None, since: _dt.datetime | None = None,
              fetches: DataFrame | None = None, pages: dict[str, R.PortalPage] = R.PORTAL_PAGES,
              places: DataFrame | None = None, lookback_days: int | None = None,
              regenerate_batch: int | None = None, completion_batch: int | None = None,
              translate_batch: int | None = None, oldest_count: int = S.OLD_REVIEW_REFRESH_COUNT,
              system: str | None = None, merge_table: str | None = None, merge_on_read: bool = False) -> dict:
    """Run the batch; returns the number of rows of each stage, the ``errors`` by
    stage, and ``version``, the version written.

    With ``merge_on_read`` the batch is written as a patch (``patch``, its number), so the write costs
    what the batch's rows cost; ``sinks.table.compact`` makes a version of it.  With ``merge_table`` (a catalog table of a row-level format) the patch is
    merged there instead: only files that hold matched keys are rewritten."""
    asof = asof or _dt.date.today()
    at = at or _dt.datetime.combine(asof, _dt.time())
    base = read_table(spark, table_root) if merge_table is None else spark.table(merge_table)
    patch, patch_rows, out, errors = None, 0, {}, {}

    def now() -> DataFrame:
        return base if patch is None else M.merge_upsert(base, patch, validate=None, batch_rows=patch_rows)

    def log(rows: DataFrame, stage: str) -> None:
        if log_path:
            run_log(rows, log_path, stage, at)

    def run(stage: str, wanted: bool, build) -> None:
        nonlocal patch, patch_rows
        if not wanted:
            return
        try:
            rows = build(now()).checkpoint()
            count = rows.count()
            if "outcome" in rows.columns:
                log(E.outcome_log(rows), stage)
                rows = rows.drop("outcome")
            M.check_unique_keys(rows)
            merged = rows if patch is None else M.merge_upsert(patch, rows, validate=None, batch_rows=count)
            merged = merged.checkpoint()
            patch, patch_rows, out[stage] = merged, merged.count(), count
        except Exception as failure:  # one stage must not end the batch
            errors[stage] = f"{type(failure).__name__}: {failure}"
            log(spark.createDataFrame([(None, f"stage failed: {errors[stage][:500]}")], "ID string, reason string"), stage)

    run("ingest", landed is not None, lambda t: ingest_stage(t, landed, since, asof))
    run("refresh", fetches is not None, lambda t: refresh_stage(t, fetches, asof, pages, oldest_count))
    run("reply", answers is not None, lambda t: reply_stage(
        t, answers, asof, lookback_days, bool(log_path), places, system))
    run("regenerate", answers is not None, lambda t: regenerate_stage(t, answers, asof, regenerate_batch, system))
    run("completion", answers is not None, lambda t: completion_stage(t, answers, completion_batch, places, system))
    run("translate", translations is not None, lambda t: translation_stage(t, translations, translate_batch, places, system))
    if patch is not None and merge_table is not None:
        M.merge_into_table(patch, merge_table, update_existing=True)
    elif patch is not None and merge_on_read:
        out["patch"] = table_patch_sink(patch, table_root)
    elif patch is not None:
        out["version"] = table_replace_sink(now(), table_root)
    if errors:
        out["errors"] = errors
    if backup_dir:
        out["backup"] = csv_backup(read_table(spark, table_root), backup_dir, at)
    if dupes_path:
        dupes_report(read_table(spark, table_root), dupes_path, asof)
    return out
