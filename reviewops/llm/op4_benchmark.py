"""Benchmark decontamination: size-partitioned MinHash containment search.

Words are runs of letters and digits of the lower-cased text; in scripts written without spaces
(``UNSPACED``) every character is a word.  A shingle is ``shingle_words`` consecutive words; an item of
fewer words is one shingle of its own length, searched at that length.  An item is found in a document if at least ``min_containment`` of the
item's distinct shingles are in the document, however long that is.

Search.  Items are partitioned by size (number of distinct shingles ``q``, classes of doubling
width).  A class with at most ``u`` shingles keeps, for each item, its ``m = floor((1 -
min_containment) * u) + 1`` shingles of least hash, a bottom-``m`` MinHash sketch.  A document that
holds the wanted share of an item lacks at most ``m - 1`` of its shingles, so it holds at least
one of the sketch: the class's upper size turns the containment into a sketch length that
loses no item (the usual bands of equal MinHash values would, as their chance to agree
falls with the document's length).  Classes whose smallest item needs more shingles than a
document has are not probed.  Every candidate is verified by the exact share of shingles,
compared as strings.

The items are a stated query set and go against all documents in blocks.  A block holds at
most ``BLOCK_SHINGLES`` shingles (an item with more is a block of its own) and only a block is broadcast;
a larger benchmark means more blocks, and each block is one pass over the documents without any
shuffle, whose result is laid down before the block is released.

Defined results: null texts are empty; an item without any word is never found, one of a few words
wherever a document has these words in a row; equal documents are found alike (one result row each); items
with equal id and text count once; an empty benchmark or table gives no rows.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from reviewops.llm import common as c

# Shingles of items that are broadcast at once (about 40 bytes each).
BLOCK_SHINGLES = 1_000_000
WORD = re.compile(r"[^\W_]+")
# Scripts without spaces between words.
UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
_UNSPACED = regex.compile(f"({UNSPACED})")
# A long text's words are read in strides of this many.
STRIDE = 1 << 17


def words_of(text: str) -> list[str]:
    low = text.lower()
    try:
        low.encode("latin-1")  # quick where nothing is unspaced
    except UnicodeEncodeError:
        low = _UNSPACED.sub(r" \1 ", low)
    return WORD.findall(low)


def _items(size: int):
    """``item``, ``parts`` (distinct shingles, as one text), their number ``q`` and their ``words``."""

    def run(batches):
        for batch in c.groups(batches):
            words = [words_of(x or "") for x in batch.column("_text").to_pylist()]
            sizes = [min(size, len(w)) for w in words]
            found = [sorted({" ".join(w[i:i + n]) for i in range(len(w) - n + 1)}) if n else [] for w, n in zip(words, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(["\n".join(x) for x in found]), pa.array([len(x) for x in found], pa.int64()), pa.array(sizes, pa.int32())],
                names=["item", "parts", "q", "words"])

    return run


class Sketches:
    """The items of one block: least-hash shingles by size class, and what verifies a candidate."""

    def __init__(self, parts: list[list[str]], min_containment: float, words: list[int] | None = None):
        """``words``: the words of each item's shingles (default: five)."""
        self.parts = [set(p) for p in parts]
        self.need = [int(np.ceil(min_containment * len(p) - 1e-9)) for p in parts]
        self.classes, self.words = [], []
        level = np.array([len(p).bit_length() for p in parts])
        words = np.array(words or [5] * len(parts))
        for n, k in sorted(set(zip(words.tolist(), level.tolist(), strict=True))):
            least = int((1 - min_containment) * ((1 << k) - 1) + 1e-9) + 1
            own = np.flatnonzero((level == k) & (words == n))
            pairs = sorted((h, int(i)) for i in own for h in sorted(xxh64_intdigest(s) for s in parts[i])[:least])
            self.words.append(n)
            self.classes.append((min(self.need[i] for i in own), np.array([h for h, _ in pairs], dtype=np.uint64),
                                 np.array([i for _, i in pairs])))

    def search(self, text: str) -> list[tuple[int, int]]:
        """``(item number, shared shingles)`` of the items found in one document."""
        words = words_of(text)
        joined = " ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        found = []
        for size in dict.fromkeys(self.words):
            found += self._search(joined, ends, size)
        return sorted(found)

    def _search(self, joined: str, ends: np.ndarray, size: int) -> list[tuple[int, int]]:
        n = len(ends) - size + 1
        if n < 1:
            return []
        starts = np.r_[0, ends[:n - 1] + 1]
        spans = list(zip(starts.tolist(), ends[size - 1:].tolist(), strict=True))
        near: set[int] = set()
        for at in range(0, n, STRIDE):
            hashes = np.fromiter((xxh64_intdigest(joined[a:b]) for a, b in spans[at:at + STRIDE]), dtype=np.uint64)
            for words, (need, index, item) in zip(self.words, self.classes, strict=True):
                if words != size or n < need:
                    continue
                lo, hi = np.searchsorted(index, hashes, "left"), np.searchsorted(index, hashes, "right")
                for k in np.flatnonzero(hi > lo):
                    near.update(item[lo[k]:hi[k]].tolist())
        if not near:
            return []
        have = {joined[a:b] for a, b in spans}
        return [(i, shared) for i in near if (shared := len(self.parts[i] & have)) >= self.need[i]]


def _search(shared):
    def run(batches):
        ids, sketches = shared.value
        for batch in c.groups(batches):
            rows, items, n_shared = [], [], []
            for row, text in enumerate(batch.column("_text").to_pylist()):
                for item, n in sketches.search(text or ""):
                    rows.append(row)
                    items.append(item)
                    n_shared.append(n)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).take(pa.array(rows)) for k in ("_id", "_k", "_j")]
                    + [ids.take(pa.array(items)), pa.array(n_shared, pa.int64()),
                       pa.array([len(sketches.parts[i]) for i in items], pa.int64())],
                    names=["_id", "_k", "_j", "item", "n_shared", "n_shingles"])

    return run


def _without(shared, text_at: int):
    def run(batches):
        _, sketches = shared.value
        for batch in batches:
            for part in c.groups([batch], batch.schema.names[text_at]):
                clean = [not sketches.search(t or "") for t in part.column(text_at).to_pylist()]
                yield part.filter(pa.array(clean, pa.bool_()))

    return run


def _blocks(items: DataFrame, salt: int = 0):
    """``items`` in parts of at most BLOCK_SHINGLES (or one item), cut by hash, again where one came out too large."""
    total, n = items.agg(F.sum("q"), F.count(F.lit(1))).first()
    if n and (total <= BLOCK_SHINGLES or n == 1):
        yield items
    elif n:
        parts = -(-2 * total // BLOCK_SHINGLES)
        for b in range(parts):
            yield from _blocks(items.filter(F.pmod(F.xxhash64("item", "parts", F.lit(salt)), F.lit(parts)) == b), salt + 1)


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle_words: int = 5, min_containment: float = 0.8,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """One row per document row and item found in it: ``_id, _k, _j, item, n_shared, n_shingles``."""
    items = query_items(benchmark, shingle_words, item_col, item_text_col)
    return _found(c.keyed(docs, id_col, text_col), items, list(_blocks(items)), min_containment)


def clean_documents(docs: DataFrame, benchmark: DataFrame, shingle_words: int = 5, min_containment: float = 0.8,
                    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    items = query_items(benchmark, shingle_words, item_col, item_text_col)
    blocks = list(_blocks(items))
    if len(blocks) < 2:
        for x in blocks:
            docs = docs.mapInArrow(_without(_sketches(x, min_containment), docs.columns.index(text_col)), docs.schema)
        return docs
    # Texts with an item, from one pass for each block; then all documents once.
    text = c.keyed(docs, text_col, text_col, carry=True)
    gone = c.stage(_found(text.select("_k", "_j", F.lit(None).cast("int").alias("_id"), "_text"), items, blocks, min_containment)
                   .select("_k", "_j").distinct(), "found-texts")
    kept = text.join(gone, ["_k", "_j"], "left_anti")
    return kept.select(*[(F.when(~F.col("_none"), F.col("_text")) if x == text_col else F.col("_row").getField(x)).alias(x) for x in docs.columns])


def query_items(benchmark: DataFrame, shingle_words: int, item_col: str, item_text_col: str) -> DataFrame:
    source = c.keyed(benchmark, item_col, item_text_col).select("_id", "_text").distinct()
    kind = source.schema["_id"].dataType.simpleString()
    return c.stage(source.mapInArrow(_items(shingle_words), f"item {kind}, parts string, q long, words int").filter("q > 0"), "items")


def _sketches(block: DataFrame, min_containment: float):
    table = block.select("item", "parts", "words").toArrow().combine_chunks()
    parts = [x.split("\n") for x in table.column("parts").to_pylist()]
    sketches = Sketches(parts, min_containment, table.column("words").to_pylist())
    return block.sparkSession.sparkContext.broadcast((table.column("item").chunk(0), sketches))


def _found(text: DataFrame, items: DataFrame, blocks: list[DataFrame], min_containment: float) -> DataFrame:
    """What ``contaminated`` returns, from ``_id, _k, _j, _text``; of several blocks one is held at a time."""
    kind = items.schema["item"].dataType.simpleString()
    shape = f"_id {text.schema['_id'].dataType.simpleString()}, _k long, _j int, item {kind}, n_shared long, n_shingles long"
    found = []
    for block in blocks:
        shared = _sketches(block, min_containment)
        rows = text.mapInArrow(_search(shared), shape)
        if len(blocks) > 1:
            rows = c.stage(rows, "found")
            shared.destroy()
        found.append(rows)
    return reduce(DataFrame.unionByName, found) if found else text.sparkSession.createDataFrame([], shape)


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    """Which items of ``benchmark`` are in which ``documents``, whole texts of both."""
    found = contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("_id").alias("doc_id"), F.col("item").alias("item_id"), "n_shared", "n_shingles")


_SQL_WORDS = (rf"regexp_extract_all(regexp_replace(lower(coalesce(text, '')), '({UNSPACED})', ' \1 ', 'g'), '[\p{{L}}\p{{N}}]+')")

OP4_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(5, len(w)) AS m FROM (SELECT DISTINCT item_id, {_SQL_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, m, array_to_string(w[i:i + m - 1], ' ') AS s
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM b) WHERE len(w) >= m)),
bs AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s
       FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM b)),
n AS (SELECT item_id, m, count(*) AS n_shingles FROM bs GROUP BY item_id, m)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_shingles) AS n_shingles
FROM bs JOIN ds USING (m, s) JOIN n USING (item_id, m) GROUP BY doc_id, item_id, m HAVING count(*) >= 0.8 * any_value(n_shingles)
"""
