"""Phrase collocation mining with counting quotient filters.

1. Texts are read once.  Each task lays its words down in shards of bounded size: numbers into the
   shard's own word list, with the list's counts.
2. The lists are added up.  Words that occur often enough get ids, and each shard is given the ids of
   its own words (a join on distinct words per shard, so a word that is everywhere is one row a shard).
3. Each shard packs its pairs of neighbouring ids, permutes them and writes counting quotient filters,
   one per leading bits of the permuted key (``filters.py``).  The sorted filters of all shards are
   merged, bucket by bucket, into exact counts; each shard gets back those of its pairs that are
   frequent in the whole corpus.
4. Phrases of three and four words are counted the same way, at places where every pair is frequent
   (a phrase is never more frequent than a pair in it).
5. Frequent phrases are scored by their weakest cut, dropped where a longer one takes most of their
   occurrences, and ranked per language.

All counts are exact: ids are packed without loss, the permutation can be undone, and whatever is left
out cannot reach the least count.  Words, pairs and buckets are spread by hash and added up inside
a task first, so a hot language, word or source is no hot task.  Ids take up to 32 bits (four billion
words that occur often enough; a ValueError names more).

Defined results: null text counts as empty, null language as ``und``; every row is a document, so
repeated rows count again; a very long text spans several shards, which share three words and lose or
double nothing; ties are ranked by phrase; a table without frequent phrases gives no rows.  Only the
named columns are read, so other columns may bear any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewops.llm import common as c
from reviewops.llm import filters as cqf

# Words of a shard (beyond it, up to one piece of a text), and keys of a bucket or rows of a window group.
SHARD_WORDS, GROUP_KEYS = 1 << 20, 1 << 20
PIECE = c.PIECE
LONGEST = 4
_CAPITALS, _BREAKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?\x0b\x0c\r"
_TABLE = bytes.maketrans(_CAPITALS + _BREAKS + b"\t", _CAPITALS.lower() + b"\n" * len(_BREAKS) + b" ")
_P, _Q = ["p1", "p2", "p3", "p4"], ["q1", "q2", "q3", "q4"]
_U = np.uint64


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, all low bytes first: the high ones are nearly all zero and compress away."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


class _Book(dict):
    """Numbers of one language's words; all languages of a shard share the running number."""

    def __init__(self, lang: str, listed: list[tuple[str, bytes]]):
        super().__init__({b"": -1, b"\n": 0})
        self.lang, self.listed = lang, listed

    def __missing__(self, word: bytes) -> int:
        self.listed.append((self.lang, word))
        self[word] = number = len(self.listed)
        return number


class _Shard:
    def __init__(self, before: list[tuple[str, bytes]] = ()):
        """``before``: the words of a text that stand just before its part in this shard."""
        self.listed, self.books = [], {}
        self.head = len(before)
        self.codes = [np.array([self.book(lang)[w] for lang, w in before], dtype=np.int32)]
        self.size = 0

    def book(self, lang: str) -> _Book:
        if lang not in self.books:
            self.books[lang] = _Book(lang, self.listed)
        return self.books[lang]

    def add(self, lang: str, data: bytes) -> None:
        words = data.translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
        codes = np.fromiter(map(self.book(lang).__getitem__, words), dtype=np.int32, count=len(words))
        self.codes.append(codes[codes >= 0])
        self.size += len(self.codes[-1])

    def end_text(self) -> None:
        self.codes.append(np.zeros(1, dtype=np.int32))

    def row(self, number: int) -> tuple[pa.RecordBatch, list[tuple[str, bytes]]]:
        """The shard as a row, and the words before a text that goes on in the next one."""
        codes = np.concatenate(self.codes)
        counts = np.bincount(codes[self.head:], minlength=len(self.listed) + 1)[1:]
        keys = [len(x := lang.encode()).to_bytes(4) + x + word for lang, word in self.listed]
        cols = [pa.array([number]), pa.array([self.head], pa.int32()), pa.array([_planes(codes)], pa.binary()),
                pa.array([keys], pa.list_(pa.binary())), pa.array([counts.tolist()], pa.list_(pa.int64()))]
        tail = codes[1 - LONGEST:]
        since = np.flatnonzero(tail == 0)
        before = [self.listed[x - 1] for x in tail[since[-1] + 1 if len(since) else 0:].tolist()]
        return pa.RecordBatch.from_arrays(cols, names=["shard", "head", "codes", "keys", "counts"]), before


def _shards(words: int, piece_bytes: int):
    def run(batches):
        number, shard = TaskContext.get().partitionId() << 32, _Shard()
        for batch in c.groups(batches):
            for lang, text in zip(batch.column("_lang").to_pylist(), c.raw(batch.column("_text")), strict=True):
                for piece in c.pieces(text, piece_bytes):
                    if shard.size >= words:
                        row, before = shard.row(number)
                        yield row
                        number, shard = number + 1, _Shard(before)
                    shard.add(lang, piece)
                shard.end_text()
        if shard.size:
            yield shard.row(number)[0]

    return run


def _buckets(left: np.ndarray, right: np.ndarray, half: int, lead: int, counts: np.ndarray | None = None) -> tuple[list[int], list[bytes]]:
    """Filters of the keys ``(left, right)``, by their first ``lead`` permuted bits."""
    keys, counts = cqf.counted(cqf.permuted(left, right, half), counts)
    bucket, (high, low) = cqf.leading(keys, 2 * half, lead)
    names, start = np.unique(bucket, return_index=True)
    edges = np.append(start, len(bucket)).tolist()
    return names.astype(np.int64).tolist(), [cqf.dump((high[a:b], low[a:b]), counts[a:b], 2 * half - lead)
                                             for a, b in zip(edges, edges[1:], strict=False)]


def _out(shard, head, buckets, blobs, ids=()) -> pa.Table:
    """Filters of a shard, and its ids (a row without a bucket)."""
    n = len(blobs) + len(ids)
    return pa.table({"shard": pa.array([shard] * n, pa.int64()), "head": pa.array([head] * n, pa.int32()),
                     "bucket": pa.array([*buckets, *[None] * len(ids)], pa.int64()), "data": pa.array([*blobs, *ids], pa.binary())})


_SHARD_SCHEMA = "shard long, head int, bucket long, data binary"
_COUNT_SCHEMA = "shard long, p1 long, p2 long, p3 long, p4 long, a long, data binary"


def _count_pairs(width: int, lead: int):
    """A shard's numbers as ids (0: a break, or a word that is too rare), and its pairs."""

    def run(shards: pa.Table, ids: pa.Table) -> pa.Table:
        if not shards.num_rows or not ids.num_rows:
            return _out(None, None, [], [])
        head, codes = shards["head"][0].as_py(), _numbers(shards["codes"][0].as_py())
        of = np.zeros(int(codes.max()) + 1, dtype=_U)
        of[ids["at"].to_numpy() + 1] = ids["id"].to_numpy().astype(_U)
        x = of[codes]
        a, b = x[:-1], x[1:]
        real = (a > 0) & (b > 0)
        # Pairs among the words before a text's part were counted in the shard before, but are asked for here too.
        counts = None
        if head > 1:
            counts = np.ones(len(a), dtype=np.int64)
            counts[:head - 1] = 0
            counts = counts[real]
        return _out(shards["shard"][0].as_py(), head, *_buckets(a[real], b[real], width, lead, counts), [_planes(x)])

    return run


def _count_longer(width: int, lead: int):
    """A shard's phrases of three and four words all of whose pairs are frequent."""

    def run(shards: pa.Table, pairs: pa.Table) -> pa.Table:
        if not shards.num_rows or not pairs.num_rows:
            return _out(None, None, [], [])
        head, x = shards["head"][0].as_py(), _numbers(shards["data"][0].as_py()).astype(_U)
        known = np.sort(np.concatenate([np.frombuffer(p, dtype="<u8") for p in pairs["data"].to_pylist()]))
        pair = x[:-1] << _U(width) | x[1:]
        ok = known[np.minimum(np.searchsorted(known, pair), len(known) - 1)] == pair
        three = ok[:-1] & ok[1:]
        four = three[:-1] & ok[2:]
        three[:max(head - 2, 0)] = False
        four[:max(head - 3, 0)] = False
        i, j = np.flatnonzero(three), np.flatnonzero(four)
        left = np.concatenate([pair[i], pair[j]])
        right = np.concatenate([x[i + 2] << _U(width), pair[j + 2]])
        return _out(shards["shard"][0].as_py(), head, *_buckets(left, right, 2 * width, lead))

    return run


def _merge(half: int, width: int, lead: int, least: int, back: bool):
    """All filters of a bucket as one: frequent keys with their counts and, with ``back``, each
    shard's own ones among them (rows with a shard)."""

    def run(group: pa.Table) -> pa.Table:
        bucket = _U(group["bucket"][0].as_py())
        bits = 2 * half - lead
        keys, counts, own = cqf.merged(group["data"].to_pylist(), bits)
        often = counts >= least
        kept = keys[0][often], keys[1][often]

        def pairs(k):
            return cqf.restored(cqf.joined(np.full(len(k[1]), bucket), k, bits), half)

        left, right = pairs(kept)
        low = _U((1 << width) - 1)
        words = [left, right, left * 0, left * 0] if half == width else [left >> _U(width), left & low, right >> _U(width), right & low]
        shards, data = [], []
        if back and len(left):
            for shard, k in zip(group["shard"].to_pylist(), own, strict=True):
                mine = np.isin(k[1], kept[1], assume_unique=True)
                if mine.any():
                    a, b = pairs((k[0][mine], k[1][mine]))
                    shards.append(shard)
                    data.append((a << _U(width) | b).astype("<u8").tobytes())
        n, m = len(left), len(shards)
        return pa.table({"shard": pa.array([None] * n + shards, pa.int64()),
                         **{p: pa.concat_arrays([pa.array(w.astype(np.int64)), pa.nulls(m, pa.int64())]) for p, w in zip(_P, words, strict=True)},
                         "a": pa.concat_arrays([pa.array(counts[often]), pa.nulls(m, pa.int64())]), "data": pa.array([None] * n + data, pa.binary())})

    return run


def _vocabulary(words: DataFrame, least: int) -> DataFrame:
    """Frequent words with ids from 1, near to each other: numbers within hash groups of bounded size,
    interleaved."""
    often = words.filter(F.col("f") >= least)
    parts = 1 + often.count() // GROUP_KEYS
    often = often.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)))
    number = F.row_number().over(Window.partitionBy("part").orderBy("key")).cast("long")
    return c.stage(often.select("key", "lang", "word", "f", ((number - 1) * parts + F.col("part") + 1).alias("id")), "phrase-ids")


def _counts(docs: DataFrame, text_col: str, lang_col: str, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All words with their counts, the vocabulary, and frequent phrases (ids in ``p1..p4``, 0 for none)."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("_lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    shards = c.stage(rows.mapInArrow(_shards(SHARD_WORDS, PIECE), "shard long, head int, codes binary, keys array<binary>, counts array<long>"),
                     "phrase-shards")
    books = shards.select("shard", F.posexplode(F.arrays_zip("keys", "counts")).alias("at", "w")).select(
        "shard", "at", F.col("w.keys").alias("key"), F.col("w.counts").alias("f"))
    # A key is the length of the language, the language and the word.
    words = books.groupBy("key").agg(F.sum("f").alias("f")).withColumn("n", F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("int"))
    words = c.stage(words.select("key", F.expr("decode(substring(key, 5, n), 'UTF-8')").alias("lang"), F.expr("substring(key, 5 + n)").alias("word"), "f"),
                    "phrase-words")
    vocabulary = _vocabulary(words, least)
    total, top = words.agg(F.sum("f")).first()[0] or 0, vocabulary.agg(F.max("id")).first()[0] or 1
    width = top.bit_length()
    if width > 32:
        raise ValueError("over four billion words reach the least count")
    ids = books.join(vocabulary.select("key", "id"), "key").select(F.col("shard").alias("of"), "at", "id")
    # Buckets for about GROUP_KEYS keys each, were every word the start of another pair.
    lead = min((total // GROUP_KEYS).bit_length(), 2 * width)
    laid = c.stage(shards.select("shard", "head", "codes").groupBy("shard").cogroup(ids.groupBy("of")).applyInArrow(
        _count_pairs(width, lead), _SHARD_SCHEMA), "phrase-pairs")
    pairs = c.stage(laid.filter("bucket is not null").groupBy("bucket").applyInArrow(_merge(width, width, lead, least, True), _COUNT_SCHEMA),
                    "phrase-pair-counts")
    longer = laid.filter("bucket is null").groupBy("shard").cogroup(
        pairs.filter("shard is not null").select(F.col("shard").alias("of"), "data").groupBy("of")).applyInArrow(
        _count_longer(width, lead), _SHARD_SCHEMA)
    longer = longer.groupBy("bucket").applyInArrow(_merge(2 * width, width, lead, least, False), _COUNT_SCHEMA)
    phrases = c.stage(pairs.filter("shard is null").select(*_P, "a").unionByName(longer.select(*_P, "a")), "phrase-counts")
    return words, vocabulary, phrases


def _cut(k: int, side: int, names: list[str]):
    zero = F.lit(0).cast("long")
    ids = [F.col(p) for p in (_P[:k] if side == 0 else _P[k:])]
    return F.struct(F.lit(2 * k + side).alias("cut"), *[x.alias(n) for x, n in zip((ids + [zero] * LONGEST)[:LONGEST], names, strict=True)])


def _size():
    return F.lit(2) + (F.col("p3") > 0).cast("int") + (F.col("p4") > 0).cast("int")


def _scored(phrases: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Candidates with language, ``l``, ``r`` and ``score`` of their weakest cut."""
    zero = F.lit(0).cast("long")
    known = phrases.select(*[F.col(p).alias(q) for p, q in zip(_P, _Q, strict=True)], F.col("a").alias("f"), F.lit(None).cast("string").alias("lang")).unionByName(
        vocabulary.select(F.col("id").alias("q1"), zero.alias("q2"), zero.alias("q3"), zero.alias("q4"), "f", "lang"))
    cuts = F.array(*[_cut(k, side, _Q) for k in (1, 2, 3) for side in (0, 1)])
    parts = phrases.select(*_P, "a", F.explode(F.filter(cuts, lambda x: x["cut"] < 2 * _size())).alias("x")).select(*_P, "a", "x.*")
    # Both sides start from files, so AQE can split a word that stands in very many phrases.
    both = c.stage(parts, "phrase-cuts").join(c.stage(known, "phrase-parts"), _Q)
    sides = both.groupBy(*_P, "a").agg(F.max("lang").alias("lang"), *[
        F.max(F.when(F.col("cut") == 2 * k + side, F.col("f"))).alias(f"{'lr'[side]}{k}") for k in (1, 2, 3) for side in (0, 1)])

    def one(k):
        score = f"(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(20, 0))) div (CAST(l{k} AS DECIMAL(20, 0)) + CAST(r{k} AS DECIMAL(20, 0)))"
        return F.when(F.col(f"l{k}").isNotNull(), F.struct(F.expr(score).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))

    return sides.select(*_P, "a", "lang", F.array_min(F.array(*[one(k) for k in (1, 2, 3)])).alias("x")).select(*_P, "a", "lang", "x.l", "x.r", "x.score")


def _absorbed(phrases: DataFrame, share: int) -> DataFrame:
    """Keys of phrases that stand inside a longer one with at least ``share`` percent of their count."""
    zero = F.lit(0).cast("long")

    def inner(start, size):
        ids = [F.col(p) for p in _P[start:start + size]]
        return F.struct(F.lit(start + size).alias("end"), F.lit(size).alias("size"), *[x.alias(q) for x, q in zip((ids + [zero] * LONGEST)[:LONGEST], _Q, strict=True)])

    parts = F.array(*[inner(s, m) for m in (2, 3) for s in range(LONGEST - m + 1)])
    inside = phrases.filter("p3 > 0").select(F.col("a").alias("longer"), F.explode(
        F.filter(parts, lambda x: (x["end"] <= _size()) & (x["size"] < _size()))).alias("x")).select("longer", "x.*")
    most = inside.groupBy(*_Q).agg(F.max("longer").alias("longer"))
    hit = phrases.join(most, [F.col(p) == F.col(q) for p, q in zip(_P, _Q, strict=True)])
    big = "CAST({} AS DECIMAL(20, 0))"
    return hit.filter(f"100 * {big.format('longer')} >= {int(share)} * {big.format('a')}").select(*_P)


def _best(scored: DataFrame, top: int) -> DataFrame:
    """Rows that can be among a language's first ``top``: all that tie with the last of them stay."""
    salts = 1 + scored.count() // GROUP_KEYS
    order = [F.desc("score"), F.desc("a")]
    few = scored.select("lang", "score", "a", F.pmod(F.xxhash64(*_P), F.lit(salts)).alias("salt"))
    few = few.withColumn("at", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("at") <= top)
    last = few.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("at") == top)
    last = last.select("lang", F.col("score").alias("least_score"), F.col("a").alias("least_a"))
    return scored.join(last, "lang", "left").filter("least_score is null or score > least_score or (score = least_score and a >= least_a)").drop(
        "least_score", "least_a")


def mine_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, share: int = 80, top: int = 2000) -> DataFrame:
    """Phrases of 2 to 4 words per language: ``lang``, ``rank``, ``phrase``, count ``a``, counts ``l`` and ``r`` of
    the two sides of its weakest cut, words ``n`` of the language, and ``score = 2000000 * a / (l + r)``, floored."""
    words, vocabulary, phrases = _counts(docs, text_col, lang_col, least)
    scored = c.stage(_scored(phrases, vocabulary).join(_absorbed(phrases, share), _P, "left_anti"), "phrase-scores")
    best = c.stage(_best(scored, top), "phrase-best")
    spelled = best.select(*_P, F.posexplode(F.array(*_P)).alias("at", "id")).filter("id > 0").join(vocabulary.select("id", "word"), "id")
    names = spelled.groupBy(*_P).agg(F.array_sort(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word")))).alias("w"))
    names = names.select(*_P, F.array_join("w.word", " ").alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(names, _P).withColumn("rank", rank).filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP11_SQL = """
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
grams AS MATERIALIZED (
  SELECT lang, m, phrase, count(*) AS a FROM (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (
      SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
      FROM pieces, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE len(w) >= m)) GROUP BY lang, m, phrase),
totals AS (SELECT lang, sum(a) AS n FROM grams WHERE m = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM grams WHERE m > 1 AND a >= 30),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS left_part, array_to_string(w[k + 1:m], ' ') AS right_part
  FROM (SELECT lang, m, phrase, a, w, unnest(generate_series(1, m - 1)) AS k FROM cand)),
often AS (SELECT lang, phrase, a FROM grams WHERE a >= 30),
scored AS (
  SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a + r.a) AS score,
    row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (2000000::HUGEINT * c.a) // (l.a + r.a), k) AS pick
  FROM cuts c JOIN often l ON l.lang = c.lang AND l.phrase = c.left_part JOIN often r ON r.lang = c.lang AND r.phrase = c.right_part),
inside AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer FROM (
    SELECT lang, w, a, s, unnest(generate_series(1, m - s + 1)) AS i FROM cand, (VALUES (2), (3)) AS sizes(s) WHERE s < m)
  GROUP BY ALL),
kept AS (
  SELECT s.lang, s.phrase, s.a, s.l, s.r, s.score,
    row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE s.pick = 1 AND (i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * s.a))
SELECT k.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept k JOIN totals t ON t.lang = k.lang WHERE rank <= 2000
"""


def op11_phrases(spark, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language of ``documents``."""
    return mine_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))
