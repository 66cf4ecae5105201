"""Joins that stay balanced when one key holds a large share of the rows.

A shuffle join sends every row of a key to one task.  Adaptive execution
splits a skewed partition only when its *bytes* stand out, and rows that repeat
one value (the same reply text a third of the time) compress to almost
nothing, so that split cannot be relied on.  Here the split is explicit: a key
is *hot* when it holds at least ``1 / HOT_KEY_BOUND`` of all rows and
``HOT_KEY_ROWS`` rows, so there are at most ``HOT_KEY_BOUND`` hot keys -- a proven
bound -- and those are joined by broadcast, leaving the rows where they are.
Every other key shuffles as usual and holds fewer than the larger of ``total /
HOT_KEY_BOUND`` and ``HOT_KEY_ROWS`` rows.  Both branches run at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# At most this many keys are broadcast (key + count: a few MB at most).
HOT_KEY_BOUND = 100_000
HOT_KEY_ROWS = 3


def hot_keys(counts: DataFrame, key: str, rows_col: str, total_rows: Column) -> DataFrame:
    """Keys whose row count is at least ``total_rows / HOT_KEY_BOUND`` and HOT_KEY_ROWS."""
    return counts.filter((F.col(rows_col) * F.lit(HOT_KEY_BOUND) >= total_rows)
                         & (F.col(rows_col) >= HOT_KEY_ROWS)).select(key)


def join_splitting_hot_keys(big: DataFrame, other: DataFrame, key: str, how: str,
                            hot: DataFrame) -> DataFrame:
    """``big.join(other, key, how)`` for ``how`` in ``inner`` / ``left_semi``,
    where ``other`` has at most one row per key and ``hot`` lists the hot keys
    of ``big`` (from ``hot_keys``).  Rows of hot keys meet a broadcast of
    their (at most ``HOT_KEY_BOUND``) partners; the other rows drop the hot
    keys by a broadcast anti join and then shuffle-join as usual."""
    hot_other = F.broadcast(other.join(F.broadcast(hot), key, "left_semi"))
    hot_rows = big.join(hot_other, key, how)
    cold_rows = big.join(F.broadcast(hot), key, "left_anti").join(other, key, how)
    return hot_rows.unionByName(cold_rows)
