"""SimHash near-dedup with bit-sliced comparison.

Fingerprint: A-Z lower-cased, words, shingles of ``shingle_words`` joined by one space
(repeats count; fewer words: the whole sequence; no words: fingerprint zero).  A bit is 1
if more than half of the shingles' XXH64 values (seed 42) have it.  Documents link at
``max_bits`` differing bits or fewer; a component is what links reach.

Search.  Only distinct fingerprints are compared.  The 64 bits are cut in ``blocks`` parts;
two fingerprints within ``max_bits`` agree on at least ``blocks - max_bits`` whole parts, so
each fingerprint is filed once for every choice of that many parts and no link is lost.  A
choice's bits are the bucket.  More ``blocks`` make smaller buckets and more copies: the
default files 15 copies in buckets of 2**21 or so; results do not depend on it.  A bucket of
more than ``LANES`` fingerprints is dealt into parts by hash and its pairs of parts are compared as
groups of their own, so no task ever holds more than two parts.

Comparison.  A block's fingerprints are stored as 64 bit planes (one bit per lane).  A
query flips each plane by its own bit, and carry-save adders count the differences of all
lanes at once in three bit-wide counters that start so that the count above ``max_bits``
overflows.  Queries whose lanes have all overflowed are abandoned.  A block gives the edges
of a spanning forest of its links, never all pairs.

Defined results: null text is empty (fingerprint zero, linked like any other); a null id
takes no part in the smallest id; equal rows get equal results; a component without any id
has a null ``component_id``; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from reviewops.llm import common as c
from reviewops.llm.graph import components, local_roots

SEED = 42
LANES = 1024
_U = np.uint64
_FULL = _U(0xFFFFFFFFFFFFFFFF)
# Planes between two looks at which queries can be abandoned; rows worked on at a time.
_LOOK, _TILE = 8, 256


def fingerprint(data: bytes, shingle_words: int) -> int:
    """SimHash of one text; a long one is read piece by piece."""
    counts, total, carry = np.zeros(64, dtype=np.int64), 0, []
    for piece in c.pieces(data.lower()):
        words = carry + piece.split()
        if len(words) < shingle_words:
            carry = words
            continue
        joined = b" ".join(words)
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends[:len(words) - shingle_words]]
        hashes = np.fromiter((xxh64_intdigest(joined[a:b - 1], SEED)
                              for a, b in zip(starts, ends[shingle_words - 1:], strict=True)),
                             dtype=_U, count=len(starts))
        for k in range(0, len(hashes), 1 << 16):
            part = hashes[k:k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
        carry = words[len(words) - shingle_words + 1:]
    if not total:
        return xxh64_intdigest(b" ".join(carry), SEED) if carry else 0
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def _fingerprints(shingle_words: int):
    def run(batches):
        for batch in c.groups(batches):
            found = np.array([fingerprint(x, shingle_words) for x in c.raw(batch.column("_text"))], dtype=_U)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_k"), batch.column("_j"), pa.array(c.signed(found))],
                names=["_id", "_k", "_j", "fp"])

    return run


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of 0/1 bytes as rows of 64-bit words, padded with zeros."""
    wide = np.packbits(bits, axis=1, bitorder="little")
    out = np.zeros((len(wide), -(-wide.shape[1] // 8) * 8), dtype=np.uint8)
    out[:, :wide.shape[1]] = wide
    return out.view("<u8")


def _add3(a, b, d):
    """Carry-save: the sum and the carry of three planes."""
    odd = a ^ b
    return odd ^ d, (a & b) | (odd & d)


def links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs ``i < j`` within ``radius`` (at most 7) bits, by bit-sliced counting."""
    n = len(fps)
    planes = _packed(((fps[None, :] >> np.arange(64, dtype=_U)[:, None]) & _U(1)).astype(np.uint8))
    spare = 7 - radius
    left, right = [], []
    for top in range(0, n, _TILE):
        rows = np.arange(top, min(top + _TILE, n))
        # Lanes that are done with: those up to the query itself, and the padding.
        over = ~_packed(np.arange(n)[None, :] > rows[:, None])
        count = [np.full(over.shape, _FULL if spare >> k & 1 else _U(0)) for k in range(3)]
        for plane in range(0, 64, 4):
            flip = [(_U(0) - ((fps[rows] >> _U(plane + k)) & _U(1)))[:, None] for k in range(4)]
            d = [planes[plane + k][None, :] ^ flip[k] for k in range(4)]
            count[0], two_a = _add3(count[0], d[0], d[1])
            count[0], two_b = _add3(count[0], d[2], d[3])
            count[1], four = _add3(count[1], two_a, two_b)
            over |= count[2] & four
            count[2] ^= four
            if plane % _LOOK == _LOOK - 4:
                alive = (over != _FULL).any(axis=1)
                if not alive.any():
                    break
                if alive.sum() < 0.75 * len(rows):
                    rows, over, count = rows[alive], over[alive], [x[alive] for x in count]
        else:
            at = np.flatnonzero((over != _FULL).any(axis=1))
            i, j = np.nonzero(np.unpackbits((~over[at]).view(np.uint8), axis=1, bitorder="little"))
            left.append(rows[at[i]])
            right.append(j)
    if not left:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(left), np.concatenate(right)


def _forest(radius: int):
    """Rows sorted by group become the forest edges of blocks of whole groups.  Small groups
    share a block: a link found across two of them is a link all the same."""

    def edges(block):
        fps = np.unique(np.concatenate(block))
        root = local_roots(len(fps), *links(fps, radius))
        at = np.flatnonzero(root != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays([pa.array(c.signed(fps[at])), pa.array(c.signed(fps[root[at]]))], names=["u", "v"])

    def run(batches):
        block, size, last, group = [], 0, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in ("t", "key", "lo", "hi")], axis=1)
            fps = batch.column("fp").to_numpy().view(_U)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(keys)], strict=True):
                key = tuple(keys[start])
                if key != last:
                    if (m := sum(map(len, group))) > 1:
                        if size and size + m > LANES // 2:
                            yield edges(block)
                            block, size = [], 0
                        block += group
                        size += m
                    group, last = [], key
                group.append(fps[start:end])
        if sum(map(len, group)) > 1:
            block += group
        if block:
            yield edges(block)

    return run


def _masks(blocks: int, max_bits: int) -> list[int]:
    """One bit mask for each choice of ``blocks - max_bits`` parts of the 64 bits."""
    edge = [64 * b // blocks for b in range(blocks + 1)]
    part = [(1 << edge[b + 1]) - (1 << edge[b]) for b in range(blocks)]
    return [sum(part[b] for b in chosen) for chosen in combinations(range(blocks), blocks - max_bits)]


def simhash_components(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                       text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """``_id, _k, _j, fp`` of every row, ``root`` (a fingerprint that names its component) and
    ``component_id`` (the smallest id in it)."""
    assert 0 <= max_bits <= 7
    schema = c.keyed(docs, id_col, text_col).schema
    rows = c.stage(c.keyed(docs, id_col, text_col).mapInArrow(
        _fingerprints(shingle_words),
        f"_id {schema['_id'].dataType.simpleString()}, _k long, _j int, fp long"), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("_id").alias("low"))

    filed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m).cast("long")).alias("key"))
        for t, m in enumerate(_masks(blocks or max_bits + 2, max_bits))])).alias("b")).select("b.*", "fp")
    sizes = filed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    parts = sizes.select("t", "key", F.ceil(F.col("n") / LANES).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = (filed.join(parts, ["t", "key"]).select("t", "key", "fp", own.alias("own"), other.alias("other"))
             .select("t", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp"))
    found = (dealt.repartition("t", "key", "lo", "hi").sortWithinPartitions("t", "key", "lo", "hi")
             .mapInArrow(_forest(max_bits), "u long, v long"))
    names = distinct.join(components(found).withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "low")
    low = names.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows.join(names.select("fp", "root").join(low, "root"), "fp").select(
        "_id", "_k", "_j", "fp", "root", "component_id")


def simhash_dedup(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits), ``component_id``."""
    return simhash_components(docs, shingle_words, max_bits, id_col, text_col).select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: that of its smallest id (null ids last, then by key)."""
    found = simhash_components(docs, shingle_words, max_bits, id_col, text_col)
    first = (found.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_k", "_j")).alias("w"))
             .select("w._k", "w._j"))
    # Rows that share a key are equal in id and text: any one of them stays.
    stays = c.keyed(docs, id_col, text_col, carry=True).join(first, ["_k", "_j"], "left_semi").dropDuplicates(["_k", "_j"])
    return stays.select(*[(F.col("_row").getField(x) if x != text_col else F.when(~F.col("_none"), F.col("_text"))).alias(x) for x in docs.columns])


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    """Four-word shingles, links at four bits, over every whole text of ``documents``."""
    return simhash_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
