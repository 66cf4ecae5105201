"""Audits over the review table: duplicate keys, status counts, declared
width violations and the before/after difference of a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_or_null
from ..schema import WIDTHS


def duplicate_ids(table: DataFrame) -> DataFrame:
    """``SELECT ID, COUNT(ID) ... GROUP BY ID HAVING COUNT(ID) > 1`` (a NULL key
    counts 0, so it is never reported)."""
    return (table.groupBy("ID").agg(F.count("ID").alias("id_count"))
            .filter(F.col("id_count") > 1))


def status_summary(table: DataFrame) -> DataFrame:
    """Counts by Portal x ApprovalStatus (replaces printed progress counters)."""
    online = F.col("OnlineYesNo")
    return (table.groupBy("Portal", "ApprovalStatus").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(blank_or_null(F.col("Response"))).alias("blank_replies"),
        F.count_if(online == "Yes").alias("online"),
        F.count_if(online == "No").alias("offline"),
        F.count_if(online.isNull()).alias("online_unknown"),
        F.count_if(F.col("ResponsePostedYesNo") == "Yes").alias("posted"),
    ))


def width_violations(table: DataFrame, widths: dict[str, int] = WIDTHS) -> DataFrame:
    """One row per (ID, column) whose text is longer than the declared width
    (the database would reject the whole batch).  Row-local: no shuffle."""
    cols = [c for c in widths if c in table.columns]
    checks = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(widths[c]).alias("width"),
                                F.length(F.col(c)).alias("length")) for c in cols])
    return (table.select("ID", F.inline(F.filter(checks, lambda s: s["length"] > s["width"]))))


# Bits of a key's hash that name its bucket, level by level.
TREE_BITS = (12, 20)
# A list of buckets is broadcast at up to so many bits: 2^20 numbers, however large the tables.
BROADCAST_BITS = 20


def _digested(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """``df`` with ``_b`` (hash of the key) and ``_d1, _d2``, 120 bits of the row's SHA-256.  Every value is written
    with its length, and null apart, so rows of different text never read alike."""
    texts = [F.col(c).cast("string") for c in [key, *cols]]
    whole = F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])
    digest = F.sha2(whole, 256)
    df = df.select("*", F.xxhash64(key).alias("_b"), digest.alias("_d"))
    return df.select("*", *[F.conv(F.substring("_d", at, 15), 16, 10).cast("decimal(38,0)").alias(n) for at, n in ((1, "_d1"), (16, "_d2"))]).drop("_d")


def _bucket(bits: int):
    return F.shiftrightunsigned("_b", 64 - bits)


def unequal_buckets(before: DataFrame, after: DataFrame, bits: int) -> DataFrame:
    """``bucket``: those whose rows differ, by the number and the sum of the digests (``_digested`` sides).  Each
    task sends one row per bucket, whatever the number of its rows."""
    sums = [s.groupBy(_bucket(bits).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum("_d1").alias("d1"), F.sum("_d2").alias("d2"))
            for s in (before, after)]
    b, a = (s.select("bucket", F.struct("n", "d1", "d2").alias(x)) for s, x in zip(sums, "ba", strict=True))
    return b.join(a, "bucket", "full_outer").filter(~F.col("b").eqNullSafe(F.col("a"))).select("bucket")


def row_diff(before: DataFrame, after: DataFrame, key: str = "ID", levels: tuple[int, ...] = TREE_BITS) -> DataFrame:
    """Per key: ``added`` / ``removed`` / ``changed`` with the changed column
    names (comma-separated, table order).  Unchanged keys are not listed.

    A hash tree over buckets of the key leads to the change: at each level the rows' digests are summed
    per bucket, and only rows of unequal buckets go on (``checkpoint()`` keeps the list of
    buckets, whose number has a bound, so it is broadcast).  What is left meets in one full outer join on the key; of text columns only
    the SHA-256 takes part.  So a small change to a large table shuffles bucket sums
    and the rows of a few buckets; ``levels=()`` joins all rows."""
    cols = [c for c in before.columns if c in after.columns and c != key]
    if levels:
        sides = [_digested(df, key, cols) for df in (before, after)]
        for bits in levels:
            live = unequal_buckets(*sides, bits).checkpoint()
            if bits <= BROADCAST_BITS:
                live = F.broadcast(live)
            sides = [s.withColumn("bucket", _bucket(bits)).join(live, "bucket", "left_semi").drop("bucket") for s in sides]
        before, after = (s.select(key, *cols) for s in sides)

    def side(df: DataFrame, name: str) -> DataFrame:
        kinds = dict(df.dtypes)
        return df.select(key, F.struct(*[
            F.unhex(F.sha2(F.col(c), 256)).alias(c) if kinds[c] == "string" else F.col(c)
            for c in cols]).alias(name))

    b, a = side(before, "b"), side(after, "a")
    j = b.join(a, key, "full_outer")
    changed = F.concat_ws(",", *[F.when(~F.col("b")[c].eqNullSafe(F.col("a")[c]), F.lit(c))
                                 for c in cols])
    status = (F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed")
              .when(changed != "", "changed"))
    return (j.select(key, status.alias("status"),
                     F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), changed)
                     .alias("changed_columns"))
            .filter(F.col("status").isNotNull()))
