"""Connected components of an edge table, as rounds of joins and minimum aggregates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewops.llm import common as c


# Edges that a task contracts at once.
HELD = 200_000


def _contract(held: int):
    """Edges of a task, about ``held`` at a time, as a star for each of their components."""

    def stars(u, v, kind):
        names, at = np.unique(np.concatenate(u + v), return_inverse=True)
        half = len(at) // 2
        root = local_roots(len(names), at[:half], at[half:])
        child = np.flatnonzero(root != np.arange(len(names)))
        return pa.RecordBatch.from_arrays([pa.array(names[child], kind), pa.array(names[root[child]], kind)], names=["u", "v"])

    def run(batches):
        u, v, size, kind = [], [], 0, None
        for batch in batches:
            for part in (batch.slice(k, held) for k in range(0, batch.num_rows, held)):
                kind = part.schema.field(0).type
                u.append(part.column(0).to_numpy(zero_copy_only=False))
                v.append(part.column(1).to_numpy(zero_copy_only=False))
                size += part.num_rows
                if size >= held:
                    yield stars(u, v, kind)
                    u, v, size = [], [], 0
        if size:
            yield stars(u, v, kind)

    return run


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v``, and no ``v`` is a ``u``."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")),
                                          F.struct(F.col("v").alias("x"), F.lit(0).alias("up")))).alias("e")).select("e.*")
    odd = (ends.groupBy("x").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
           .filter("up > 1 OR up = 1 AND least = 0"))
    return odd.limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``u``, ``v`` of one orderable type,
    either direction, repeats and loops allowed); ``root`` is the least node reachable.

    Tasks contract the edges that they hold to stars.  Then each round hangs every
    neighbour of a node that is above it on the least neighbour (large star) and does the
    same with the neighbours below (small star), until the edges are a star forest; a chain
    of ``n`` nodes ends in about ``log n`` rounds.  A node with very many neighbours is a
    join key, which adaptive execution splits, never a list.  Each step starts from a
    written table, so a lost executor costs at most one."""
    kind = edges.schema["u"].dataType.simpleString()

    def contracted(e: DataFrame) -> DataFrame:
        return e.select("u", "v").mapInArrow(_contract(HELD), f"u {kind}, v {kind}").distinct()

    now = c.stage(contracted(edges.filter("u <> v")), "edges")
    while not _is_star_forest(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Minima are staged: a join of two plain shuffles is one that AQE can split at a hub.
        least = c.stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        large = c.stage(large, "large")
        least = c.stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = c.stage(contracted(small.select("e.*").filter("u <> v")), "small")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least linked index of each of ``n`` items under links ``i - j`` (one block in memory)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label
