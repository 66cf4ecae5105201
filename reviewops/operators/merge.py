"""Key joins and the merge of an incoming batch into the review table.

Semantics (whole-row replacement, NULLs included; by column name):

* ``insert``  : table + incoming rows whose ID is unknown
* ``update``  : rows whose ID exists are replaced; unknown incoming rows dropped
* ``upsert``  : existing replaced, unknown inserted
* ``noop``    : neither flag -> table unchanged

Physical shape: every join is on ``ID`` and only the ``ID`` column of the other
side takes part.  With ``batch_rows``, the measured size of a staged batch (see
``measured``), up to ``BROADCAST_IDS`` incoming IDs are broadcast, and the table is
only scanned.  Without it, or beyond that bound, the planner decides; it sees
no more than an estimate, so it may shuffle the whole table by ``ID`` (AQE turns
the join into a broadcast only after that shuffle is written).  With ``stored``, for
sides that are Parquet files behind filters and row-local columns, no wide row is shuffled at any
batch size: IDs meet with the places (file, row number) of their rows, and each scan
drops or keeps rows by one bit a row (see ``at_ids``).  The incoming key must be unique and
non-null (the staging primary key): ``guard_unique_keys`` (lazy, fails the job)
or ``check_unique_keys`` (eager, lists at most 20 keys) enforce it with one
aggregation (partial counts per task, so a hot key cannot overload one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import COLUMN_NAMES


# Incoming IDs that are broadcast at most (about 100 bytes each on an executor).
BROADCAST_IDS = 1_000_000


# Rows of one bitmap (4 KB), and bitmaps that are broadcast at most (64 MB, half a billion rows).
PART_ROWS = 32_768
BROADCAST_PARTS = 16_384


class DuplicateKeyError(ValueError):
    pass


def measured(staged: DataFrame) -> dict[str, int]:
    """``batch_rows`` of a staged (checkpointed or written) batch, as a keyword
    for the functions below: one count over the staged files."""
    return {"batch_rows": staged.count()}


def _ids(df: DataFrame, key: str, batch_rows: int | None = None) -> DataFrame:
    ids = df.select(key)
    return F.broadcast(ids) if batch_rows is not None and batch_rows <= BROADCAST_IDS else ids


def known_ids(incoming: DataFrame, table: DataFrame, key: str = "ID",
              batch_rows: int | None = None) -> DataFrame:
    """IDs of the batch that the table already holds: the table's ID column is
    the probe side and the batch's IDs the build side; the result is at most
    as large as the batch."""
    return table.select(key).join(_ids(incoming, key, batch_rows), key, "left_semi")


def at_ids(rows: DataFrame, ids: DataFrame, key: str = "ID", inside: bool = True) -> DataFrame:
    """Rows of stored Parquet files (read behind filters and row-local columns, one row for a row) whose key is
    (``inside``) or is not among ``ids``; a NULL key is not.  Only keys and places are shuffled;
    the places found are laid down (``checkpoint()``) as bitmaps, broadcast while they are few."""
    row = F.col("_metadata.row_index")
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.expr(f"_metadata.row_index div {PART_ROWS}").alias("_part"),
                         (row % PART_ROWS).alias("_pos"))
    marks = placed.select(key, "_file", "_part", "_pos").join(ids.select(key), key, "left_semi") \
        .groupBy("_file", "_part").agg(F.bitmap_construct_agg("_pos").alias("_bits")).checkpoint()
    if marks.count() > BROADCAST_PARTS:
        return rows.join(ids.select(key), key, "left_semi" if inside else "left_anti")
    byte = F.conv(F.hex(F.substring("_bits", F.expr("_pos div 8 + 1").cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (F.col("_pos") % 8).cast("int")) == 1, F.lit(False))
    return placed.join(F.broadcast(marks), ["_file", "_part"], "left").filter(hit if inside else ~hit).select(*rows.columns)


def existing_keys(incoming: DataFrame, table: DataFrame, key: str = "ID",
                  batch_rows: int | None = None) -> DataFrame:
    """``ID IN (SELECT ID FROM table)``."""
    return incoming.join(known_ids(incoming, table, key, batch_rows), key, "left_semi")


def new_keys(incoming: DataFrame, table: DataFrame, key: str = "ID",
             batch_rows: int | None = None) -> DataFrame:
    """``ID NOT IN (SELECT ID FROM table)`` for a non-null key (plain anti join
    against the batch's known IDs; the null-aware form could only broadcast)."""
    return incoming.join(known_ids(incoming, table, key, batch_rows), key, "left_anti")


def duplicate_keys(df: DataFrame, key: str = "ID") -> DataFrame:
    """Keys that occur more than once, plus a NULL key if present."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") > 1) | F.col(key).isNull()))


def check_unique_keys(df: DataFrame, key: str = "ID", report: int = 20) -> None:
    bad = duplicate_keys(df, key).limit(report).collect()
    if bad:
        listed = ", ".join(f"{r[key]!r} x{r['n']}" for r in bad)
        raise DuplicateKeyError(f"incoming batch has duplicate or NULL {key}: {listed}")


def guard_unique_keys(incoming: DataFrame, key: str = "ID") -> DataFrame:
    """Lazy form of the key check: a scalar subquery counts bad keys once per
    job; any bad key makes the job fail with ``raise_error`` (nothing is
    written), without an extra action while the plan is built."""
    n_bad = duplicate_keys(incoming, key).agg(F.count(F.lit(1))).scalar()
    msg = F.concat(F.lit(f"DUPLICATE_KEY: incoming batch has duplicate or NULL {key} values: "),
                   n_bad.cast("string"))
    return incoming.filter(F.when(n_bad > 0, F.raise_error(msg)).isNull())


def merge(table: DataFrame, incoming: DataFrame, insert_new: bool = True,
          update_existing: bool = False, key: str = "ID", validate: str | None = "lazy",
          batch_rows: int | None = None, ids: DataFrame | None = None, stored: bool = False) -> DataFrame:
    """``validate``: ``"lazy"`` (fail the job), ``"eager"`` (raise
    ``DuplicateKeyError`` now, listing keys) or ``None``.  ``batch_rows``: the
    measured number of incoming rows, if known.  ``ids``: the incoming keys (each once
    or more), where they are cheaper to read than from ``incoming`` (upsert only).
    ``stored``: table and incoming rows are read from Parquet files (see ``at_ids``)."""
    if not (insert_new or update_existing):
        return table
    if validate == "eager":
        check_unique_keys(incoming, key)
    keys = incoming if ids is None else ids
    if validate == "lazy":
        incoming = guard_unique_keys(incoming, key)
    incoming = incoming.select(*table.columns)
    if stored:
        kept = at_ids(table, keys, key, inside=False) if update_existing else table
        if not (insert_new and update_existing):
            incoming = at_ids(incoming, table, key, inside=update_existing)
        return kept.unionByName(incoming)
    if insert_new and update_existing:
        kept = table.join(_ids(incoming if ids is None else ids, key, batch_rows), key, "left_anti")
        return kept.unionByName(incoming)
    if insert_new:
        return table.unionByName(new_keys(incoming, table, key, batch_rows))
    kept = table.join(_ids(incoming, key, batch_rows), key, "left_anti")
    return kept.unionByName(existing_keys(incoming, table, key, batch_rows))


def merge_into_table(incoming: DataFrame, table_name: str, insert_new: bool = True,
                     update_existing: bool = False, key: str = "ID",
                     validate: str | None = "lazy") -> None:
    """The same merge as a row-level ``MERGE`` into a catalog table whose
    format supports it (Delta Lake, Apache Iceberg, ...).  Only the files that
    hold matched keys are rewritten, where ``merge`` + ``table_replace_sink``
    write a whole new version: at 100 TB with a daily batch of updates this is
    the difference between rewriting a few files and the whole table.  The
    format's own commit makes the write atomic.  A plain Parquet table cannot
    do this; Spark refuses it before writing anything."""
    if not (insert_new or update_existing):
        return
    if validate == "eager":
        check_unique_keys(incoming, key)
    elif validate == "lazy":
        incoming = guard_unique_keys(incoming, key)
    target = table_name.split(".")[-1]
    src = incoming.alias("_src")
    w = src.mergeInto(table_name, F.col(f"{target}.{key}") == F.col(f"_src.{key}"))
    if update_existing:
        w = w.whenMatched().updateAll()
    if insert_new:
        w = w.whenNotMatched().insertAll()
    w.merge()


def merge_insert(table, incoming, **kw):
    return merge(table, incoming, True, False, **kw)


def merge_update(table, incoming, **kw):
    return merge(table, incoming, False, True, **kw)


def merge_upsert(table, incoming, **kw):
    return merge(table, incoming, True, True, **kw)


def dedupe_incoming(df: DataFrame, order_col: str, key: str = "ID") -> DataFrame:
    """Keep the first row per key in feed order (``order_col`` ascending).

    An aggregation (``min_by`` over the row struct), not a window: partial
    aggregation collapses a hot key inside each task before the shuffle, so a
    key holding a third of the rows never lands whole in one task.
    """
    cols = [c for c in df.columns if c != order_col]
    first = F.min_by(F.struct(*[F.col(c) for c in cols if c != key]), F.col(order_col))
    return (df.groupBy(key).agg(first.alias("_r"))
            .select(key, "_r.*").select(*cols))


def schema_conform(df: DataFrame, names: list[str] = COLUMN_NAMES) -> DataFrame:
    """``null_template``: every table column present (missing -> typed NULL),
    in table order; extra columns dropped."""
    from ..schema import REVIEW_SCHEMA

    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType)
                       .alias(f.name) for f in REVIEW_SCHEMA.fields if f.name in names])
