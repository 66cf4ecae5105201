"""Substring dedup by level-wise doubling.

A window is ``min_words`` consecutive words of one document.  Every word covered by a
window whose word sequence starts at any other place (another document or elsewhere in
the same one) is removed; windows are judged on the input.

Levels.  A window can repeat only if its windows of half that length repeat, so repeats
are found bottom-up and only windows that repeat at one length are extended to twice it (9,
18 and 35 words for windows of 35):

1. A quarter (``s`` words).  Of the windows of ``s`` words inside a window of ``n``, the one with the
   least hash is its *anchor*; equal windows have equal anchors, so counting anchors alone
   (about ``2 / (n - s + 2)`` of all positions) loses nothing.  Anchors seen once end here.
   All windows of ``n`` words round an anchor span one run (``2n - s`` words, less at a
   document's ends).  Where that whole run repeats, all of them do, and their document
   needs no further level there: this settles the inside of every repeated passage.
2. A half.  Of the other anchors (the rims of repeated passages), with one member of every
   class of equal runs that shares the anchor, the two windows of half the length that
   begin and end with the anchor are counted: every window of ``n`` words round it holds
   one of the two.  Anchors with neither repeated end here.
3. The whole length.  What survives is extended to the windows of ``n`` words, and these are
   counted.  Nothing longer needs a look: what a window of ``2n`` words covers is covered by
   its windows of ``n``.

Windows are judged equal by 128 bits of hash (anchor and run, or two window hashes).

Cost: two reads of the text, and one shuffle of it by row key that both later steps use;
besides that, hashes of anchors only.  Counts are combined before the shuffle, so a
passage held by a third of all rows is one row per task; nothing is gathered per passage.

Defined results: null or blank text has no words and an empty ``kept_text``; fewer than
``min_words`` words are kept whole; rows equal in id and text get equal results, and each
counts as a place of its own (so both lose their windows); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewops.llm import common as c

ANCHORS = "h long, r long, _k long, _j int, a int, before long, after long"
WINDOWS = "w1 long, w2 long, _k long, _j int, i int"
KEPT = "_id {id}, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept binary"


def _sizes(n: int) -> tuple[int, int]:
    """Half and quarter of a window's length, rounded up."""
    half = (n + 1) // 2
    return half, (half + 1) // 2


def _anchor_of_windows(seeds: np.ndarray, per_window: int) -> np.ndarray:
    """For every window, the place of its leftmost least seed."""
    view = np.lib.stride_tricks.sliding_window_view(seeds, per_window)
    return np.arange(len(view)) + view.argmin(axis=1)


def _prepare(data: bytes, n: int):
    """Word hashes, run hash, hash of each seed, and each window's anchor; None if too short."""
    words = c.word_hashes(data)
    if len(words) < n:
        return None
    _, s = _sizes(n)
    run = c.RunHash(words)
    seeds = run.windows(s)
    return words, run, seeds, _anchor_of_windows(seeds, n - s + 1)


def _emit_anchors(n: int):
    half, s = _sizes(n)

    def hashes(run, start, end, there):
        """Hashes of the runs that are there, null for the others."""
        found = run(np.where(there, start, 0), np.where(there, end, 0))
        return pa.array(c.signed(found), mask=~there)

    def emit(batches):
        for batch in c.groups(batches):
            out = [[], [], [], [], []]
            rows = []
            for row, data in enumerate(c.raw(batch.column("_text"))):
                if (got := _prepare(data, n)) is None:
                    continue
                words, run, seeds, anchor = got
                at = anchor[np.r_[True, anchor[1:] != anchor[:-1]]]
                left, right = np.maximum(at - (n - s), 0), np.minimum(at + n, len(words))
                place = ((at - left) * (2 * n) + right - at).astype(np.uint64)
                out[0].append(seeds[at])
                out[1].append(c.mix(c.RunHash(words, salt=1)(left, right) + place))
                out[2].append(at)
                out[3].append(hashes(run, at + s - half, at + s, at + s >= half))
                out[4].append(hashes(run, at, at + half, at + half <= len(words)))
                rows.append((row, len(at)))
            take = np.repeat([r for r, _ in rows], [m for _, m in rows]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.signed(c.spread(out[0], np.uint64))), pa.array(c.signed(c.spread(out[1], np.uint64))),
                 batch.column("_k").take(pa.array(take)), batch.column("_j").take(pa.array(take)),
                 pa.array(c.spread(out[2], np.int64).astype(np.int32)),
                 *[pa.concat_arrays(x) if x else pa.array([], pa.int64()) for x in out[3:]]],
                names=["h", "r", "_k", "_j", "a", "before", "after"])

    return emit


def _emit_windows(n: int):
    """The windows whose anchor is one of those listed in ``at``."""

    def emit(batches):
        for batch in c.groups(batches):
            first, second, place, rows = [], [], [], []
            for row, (data, at) in enumerate(zip(c.raw(batch.column("_text")), batch.column("at").to_pylist(),
                                                 strict=True)):
                words, run, _, anchor = _prepare(data, n)
                i = np.flatnonzero(np.isin(anchor, np.asarray(at)))
                first.append(run(i, i + n))
                second.append(c.RunHash(words, salt=2)(i, i + n))
                place.append(i)
                rows.append((row, len(i)))
            take = np.repeat([r for r, _ in rows], [m for _, m in rows]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.signed(c.spread(first, np.uint64))), pa.array(c.signed(c.spread(second, np.uint64))),
                 batch.column("_k").take(pa.array(take)), batch.column("_j").take(pa.array(take)),
                 pa.array(c.spread(place, np.int64).astype(np.int32))], names=["w1", "w2", "_k", "_j", "i"])

    return emit


def _apply(n: int):
    _, s = _sizes(n)

    def apply(batches):
        for batch in c.groups(batches):
            n_words, n_removed, spans, kept = [], [], [], []
            for data, whole, starts in zip(c.raw(batch.column("_text")), batch.column("whole").to_pylist(),
                                           batch.column("starts").to_pylist(), strict=True):
                if not whole and not starts:
                    total, parts = 0, []
                    for piece in c.pieces(data):
                        words = piece.split()
                        total += len(words)
                        if words:
                            parts.append(b" ".join(words))
                    n_words.append(total)
                    n_removed.append(0)
                    spans.append([])
                    kept.append(b" ".join(parts))
                    continue
                words = data.split()
                # A whole run covers [a - (n - s), a + n), clipped; a window [i, i + n).
                edge = np.zeros(len(words) + 1, dtype=np.int32)
                a, i = np.asarray(whole or [], dtype=np.int64), np.asarray(starts or [], dtype=np.int64)
                np.add.at(edge, np.maximum(a - (n - s), 0), 1)
                np.add.at(edge, np.minimum(a + n, len(words)), -1)
                np.add.at(edge, i, 1)
                np.add.at(edge, i + n, -1)
                gone = np.cumsum(edge[:-1]) > 0
                turn = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(turn[::2], turn[1::2], strict=True)])
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 pa.array(kept, pa.binary())], names=["_id", "n_words", "n_removed", "spans", "kept"])

    return apply


def substring_dedup(docs: DataFrame, min_words: int = 35, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_removed``, ``removed_spans`` (word
    offsets, end exclusive) and ``kept_text`` (kept words joined by one space)."""
    n = min_words
    text = c.keyed(docs, id_col, text_col)
    anchors = text.select("_k", "_j", "_text").mapInArrow(_emit_anchors(n), ANCHORS)

    # Level 1: anchors that occur more than once.
    # Staged, so that the join reads plain shuffles on both sides, which AQE splits at hot anchors.
    repeated = c.stage(anchors.groupBy("h").count().filter("count > 1").select("h"), "repeated")
    alive = c.stage(anchors.join(repeated, "h", "left_semi"), "anchors")

    # Still level 1: classes of equal runs round an anchor.
    runs = alive.groupBy("h", "r").agg(F.count("*").alias("n"), F.min(F.struct("_k", "_j", "a", "before", "after")).alias("one"))
    runs = c.stage(runs, "runs")
    whole = alive.join(runs.filter("n > 1").select("h", "r"), ["h", "r"], "left_semi").select("_k", "_j", "a")

    # Level 2: one member of each class, where an anchor has several.
    mixed = c.stage(runs.groupBy("h").count().filter("count > 1").select("h"), "mixed")
    halves = c.stage(runs.join(mixed, "h", "left_semi").select("one.*").select(
        "_k", "_j", "a", F.explode(F.array("before", "after")).alias("w")).filter("w IS NOT NULL"), "halves")
    repeated = c.stage(halves.groupBy("w").count().filter("count > 1").select("w"), "repeated")

    # Level 3: the windows round what is left.
    at = halves.join(repeated, "w", "left_semi").groupBy("_k", "_j").agg(F.collect_set("a").alias("at"))
    # Same columns of the text as in the last join, so that both read one shuffle of it.
    windows = (text.join(at, ["_k", "_j"]).select("_k", "_j", "_id", "_text", "at")
               .mapInArrow(_emit_windows(n), WINDOWS))
    twice = windows.groupBy("w1", "w2").count().filter("count > 1").select("w1", "w2")
    starts = windows.join(twice, ["w1", "w2"], "left_semi").select("_k", "_j", "i")

    marks = (whole.select("_k", "_j", "a", F.lit(None).cast("int").alias("i"))
             .unionByName(starts.select("_k", "_j", F.lit(None).cast("int").alias("a"), "i"))
             .groupBy("_k", "_j").agg(F.collect_set("a").alias("whole"), F.collect_set("i").alias("starts")))
    id_type = text.schema["_id"].dataType.simpleString()
    out = (text.join(marks, ["_k", "_j"], "left").select("_id", "_text", "whole", "starts")
           .mapInArrow(_apply(n), KEPT.format(id=id_type)))
    return out.select(F.col("_id").alias(id_col), "n_words", "n_removed", F.col("spans").alias("removed_spans"),
                      F.col("kept").cast("string").alias("kept_text"))


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Windows of 35 words over every whole text of ``documents``."""
    out = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
