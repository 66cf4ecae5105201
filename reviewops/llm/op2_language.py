"""Language identification by interpolated Kneser-Ney character models.

A text is read as its words (letters with their marks, lower-cased); a word's characters and
its end are predicted from the three characters before, padded with spaces, so an equal
word has an equal cost and is scored once per group of rows.

Learning (documents with a language, by the crc32 of their id modulo 4: folds 0 and 1 for
counts, fold 3 for calibration, never fold 2):

* Spark sums the counts of every 4-gram type over all texts, per language; tasks count before the
  shuffle.  Lower orders come from the types (continuation counts), with one absolute
  discount per order from the numbers of types seen once and twice.
* The model of each order is a sorted array of hashes for all languages together, with one
  row of probabilities (or of interpolation weights) for each hash, found by binary search.
  Every type is kept.  Arrays of more than ``4 * 2**hash_bits`` values (types times languages)
  are not broadcast: the same probabilities are tables by gram then, the 4-grams of the
  distinct words of the texts are joined to them, and costs are summed by word and by text.
* Calibration is a histogram over all documents of its fold: the score is a logistic function
  of the margin to the second language; a text is rejected where its cross-entropy is beyond
  what (nearly) all labelled texts of its length have, or its score is below ``min_score``.
* A length with too few labelled texts is held against chance: what the letters of the text's
  language cost when each is drawn by its frequency alone, with two standard errors for the
  length.  So there is a finite limit at every length, however small the corpus.

The language with the least cross-entropy per character wins (ties: first by name).

Defined results: ``und`` with score 0, rejected, for null text or a text without a letter; a null
id is in no fold (never learned from, ``held_out`` false); without any labelled text everything
is ``und``; equal rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewops.llm import common as c

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
ORDER = 4
# Distinct words that a task holds before it turns them into counts; words scored at once.
HELD_WORDS, SCORED_WORDS = 50_000, 10_000
_MULT = np.uint64(0x9E3779B97F4A7C15)
# Calibration histogram: width of a cross-entropy bin (nats), of a margin bin, least support.
CE_BIN, MARGIN_BIN, SUPPORT = 0.05, 0.25, 50
# Bits of ``a`` that a gram of each order has (three, two, one or no code points before the last).
MASKS = {order: (1 << 21 * (order - 1)) - 1 for order in range(1, ORDER + 1)}
# Classes of length: powers of two of the number of characters.
CLASSES = 40


def _stream(words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the padded words, the places to predict, and each word's first place."""
    text = "   " + "   ".join(words) + "   "
    x = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    at = np.flatnonzero((x[3:] != 32) | (x[2:-1] != 32)) + 3
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    return x, at, np.r_[0, np.cumsum(size)[:-1]]


def _gram_keys(x: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` code points that end at each place."""
    key = np.full(len(at), np.uint64(order))
    for back in range(order):
        key = c.mix(key * _MULT + x[at - back])
    return key


def _pack(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram at each place: three code points in ``a``, the last in ``b``."""
    return (x[at - 3] << np.uint64(42)) | (x[at - 2] << np.uint64(21)) | x[at - 1], x[at]


def _count_types(batches):
    """4-gram types with their counts."""

    def flush(lang, words):
        x, at, start = _stream(list(words))
        weight = np.repeat(np.fromiter(words.values(), dtype=np.int64), np.diff(np.r_[start, len(at)]))
        a, b = _pack(x, at)
        order = np.lexsort((b, a))
        a, b, weight = a[order], b[order], weight[order]
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(first)), pa.array(c.signed(a[first])), pa.array(b[first].astype(np.int32)),
             pa.array(np.add.reduceat(weight, first))], names=["lang", "a", "b", "n"])

    held: dict[str, Counter] = {}
    for batch in batches:
        for text, lang in zip(batch.column("_text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            words = held.setdefault(lang, Counter())
            words.update(WORD.findall(text.lower()))
            if len(words) > HELD_WORDS:
                yield flush(lang, held.pop(lang))
    for lang, words in held.items():
        if words:
            yield flush(lang, words)


@dataclass
class Model:
    langs: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]      # by order: hashes, probability by language (0: not seen)
    contexts: list[tuple[np.ndarray, np.ndarray]]   # by order: hashes, weight of the next lower order
    floor: np.ndarray                               # probability of a character that a language never showed
    chance: np.ndarray | None = None                # mean and spread of a character's cost by its frequency, by language
    logistic: tuple[float, float] = (0.0, 1.0)
    limits: np.ndarray | None = None                # by length class and language: highest cross-entropy accepted
    min_score: float = 0.05
    # By order, for a model too large for arrays: (lang, a, b, p) and (lang, a, weight).
    tables: list[tuple[DataFrame, DataFrame]] | None = None

    def word_costs(self, words: list[str]) -> np.ndarray:
        """Negative log probability of each word (rows) in each language."""
        x, at, start = _stream(words)
        p = np.broadcast_to(self.floor, (len(at), len(self.langs)))
        for order in range(1, ORDER + 1):
            (keys, prob), (ckeys, weight) = self.grams[order - 1], self.contexts[order - 1]
            if order > 1:
                ctx = _gram_keys(x, at - 1, order - 1)
                k = np.minimum(np.searchsorted(ckeys, ctx), len(ckeys) - 1)
                p = np.where((ckeys[k] == ctx)[:, None], weight[k], 1.0) * p
            own = _gram_keys(x, at, order)
            k = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            seen = np.where((keys[k] == own)[:, None], prob[k], 0.0)
            p = np.where(seen > 0, seen, p)
        return np.add.reduceat(-np.log(p), start, axis=0)

    def score(self, margin: np.ndarray) -> np.ndarray:
        a, b = self.logistic
        return 1 / (1 + np.exp(-np.clip(a + b * margin, -30, 30)))


def _estimate(a: np.ndarray, last: np.ndarray, n: np.ndarray):
    """Interpolated Kneser-Ney for one language from its 4-gram types: by order, hashes with
    probabilities and context hashes with weights."""
    low = np.uint64((1 << 21) - 1)
    x = np.stack([(a >> np.uint64(42)) & low, (a >> np.uint64(21)) & low, a & low, last], axis=1)
    counts = n.astype(np.float64)
    levels = []
    for order in range(ORDER, 0, -1):
        # Rows are types of this order; the count of a lower-order type is the number of
        # types of the order above that end in it.
        flat = x.ravel()
        at = np.arange(len(x)) * order + order - 1
        keys = _gram_keys(flat, at, order)
        ctx = _gram_keys(flat, at - 1, order - 1) if order > 1 else np.zeros(len(x), dtype=np.uint64)
        levels.append((keys, ctx, counts, _gram_keys(flat, at, order - 1) if order > 1 else None))
        if order > 1:
            tail = np.ascontiguousarray(x[:, 1:])
            key = _gram_keys(tail.ravel(), np.arange(len(tail)) * (order - 1) + order - 2, order - 1)
            _, first, types = np.unique(key, return_index=True, return_counts=True)
            x, counts = tail[first], types.astype(np.float64)
    grams, contexts, lower = [], [], None
    floor = 0.0
    for keys, ctx, counts, suffix in reversed(levels):
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        d = once / (once + 2 * twice) if once and twice else 0.5
        names, which = np.unique(ctx, return_inverse=True)
        total = np.bincount(which, counts)
        weight = d * np.bincount(which) / total
        if lower is None:
            base = 1 / (len(keys) + 1)
            floor = weight[0] * base
        else:
            base = lower[1][np.searchsorted(lower[0], suffix)]
        p = (counts - d) / total[which] + weight[which] * base
        order = np.argsort(keys)
        lower = keys[order], p[order]
        grams.append(lower)
        contexts.append((names, weight))
    return grams, contexts, floor


def _chance(last: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Mean and standard deviation of the cost of a character drawn by its frequency."""
    p = np.bincount(np.unique(last, return_inverse=True)[1], n)
    p = p / p.sum()
    mean = -(p * np.log(p)).sum()
    return float(mean), float(np.sqrt(max((p * np.log(p) ** 2).sum() - mean ** 2, 0.0)))


def _limits(cells, chance: np.ndarray, accept: float, slack: float) -> np.ndarray:
    """Highest cross-entropy accepted, by length class and language, from the calibration histogram."""
    found = np.full(CLASSES, np.nan)
    for size, own in cells.groupby("size"):
        by_ce = own.groupby("ce")["n"].sum().sort_index()
        if by_ce.sum() >= SUPPORT:
            inside = by_ce.cumsum() >= accept * by_ce.sum()
            found[size] = (int(inside.idxmax()) + 1) * CE_BIN * (1 + slack)
    have = np.flatnonzero(~np.isnan(found))
    error = 2 * chance[1] / np.sqrt(2.0 ** np.arange(CLASSES))[:, None]
    limits = chance[0] * (1 + slack) + error
    for size in range(CLASSES):
        shorter, longer = have[have <= size], have[have >= size]
        if len(shorter):
            # A class with few texts takes over from the next shorter one, whose texts vary more.
            limits[size] = found[shorter[-1]]
        elif len(longer):
            limits[size] = np.maximum(limits[size], found[longer[0]])
    return limits


def _together(parts: list[tuple[np.ndarray, np.ndarray]], absent: float):
    """Sorted hashes of all languages, and a column of values for each."""
    keys = np.unique(np.concatenate([k for k, _ in parts]))
    values = np.full((len(keys), len(parts)), absent)
    for lang, (k, v) in enumerate(parts):
        values[np.searchsorted(keys, k), lang] = v
    return keys, values


def _length_class(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n, 1)), CLASSES - 1).astype(np.int32)


def judge(model: Model, texts: list[str | None]):
    """By text: number of characters, index of the best language, cross-entropy, margin.

    The margin is the gap to the second language per character, times the square root of the
    number of characters (zero if there is one language only)."""
    known: dict[str, int] = {}
    numbers = [[known.setdefault(w, len(known)) for w in WORD.findall((t or "").lower())] for t in texts]
    n = np.zeros(len(texts))
    total = np.zeros((len(texts), len(model.langs)))
    if known and model.langs:
        words = list(known)
        costs = np.concatenate([model.word_costs(words[k:k + SCORED_WORDS]) for k in range(0, len(words), SCORED_WORDS)])
        size = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) + 1
        for row, own in enumerate(numbers):
            if own:
                n[row], total[row] = size[own].sum(), costs[own].sum(axis=0)
    return (n, *_standing(n, total))


def _standing(n: np.ndarray, total: np.ndarray):
    """Index of the best language, cross-entropy and margin from the cost in each language."""
    if not total.shape[1]:
        return np.zeros(len(n), dtype=np.int64), np.zeros(len(n)), np.zeros(len(n))
    mean = total / np.maximum(n, 1)[:, None]
    best = mean.argmin(axis=1)
    ordered = np.sort(mean, axis=1)
    gap = ordered[:, 1] - ordered[:, 0] if total.shape[1] > 1 else np.zeros(len(n))
    return best, ordered[:, 0], gap * np.sqrt(n)


def _judged(model: Model, batches):
    """``judge`` of groups of rows, which have their texts or what ``_with_costs`` adds."""
    if model.grams or not model.langs:
        for batch in c.groups(batches, limit=c.GROUP_BYTES // 4):
            yield batch, judge(model, batch.column("_text").to_pylist())
        return
    for batch in batches:
        if batch.num_rows:
            n = batch.column("_n").to_numpy(zero_copy_only=False)
            yield batch, (n, *_standing(n, np.array(batch.column("_total").to_pylist())))


def _histogram(shared):
    def run(batches):
        model = shared.value
        for batch, (n, best, ce, margin) in _judged(model, batches):
            right = np.array([model.langs[b] == lang for b, lang in zip(best, batch.column("lang").to_pylist(), strict=True)])
            cells = Counter(zip(right.tolist(), _length_class(n).tolist(), (ce / CE_BIN).astype(int).tolist(),
                                np.minimum(margin / MARGIN_BIN, 400).astype(int).tolist(), (n > 0).tolist(), strict=True))
            yield pa.RecordBatch.from_pylist(
                [{"right": r, "size": s, "ce": e, "margin": m, "n": k} for (r, s, e, m, some), k in cells.items() if some],
                pa.schema([("right", pa.bool_()), ("size", pa.int32()), ("ce", pa.int32()), ("margin", pa.int32()), ("n", pa.int64())]))

    return run


def _tables(types: DataFrame, langs: list[str]):
    """``_estimate`` and ``_chance`` as tables: by order, probabilities and weights; the floors; the chances."""
    spark, levels = types.sparkSession, {ORDER: types}
    for order in range(ORDER - 1, 0, -1):
        levels[order] = c.stage(levels[order + 1].groupBy("lang", _masked("a", order).alias("a"), "b")
                                .agg(F.count(F.lit(1)).alias("n")), f"types{order}")
    out, floor = [], {}
    for order in range(1, ORDER + 1):
        sizes = levels[order].groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"),
                                                  F.count(F.lit(1)).alias("types")).collect()
        d = {r.lang: r.once / (r.once + 2 * r.twice) if r.once and r.twice else 0.5 for r in sizes}
        base = {r.lang: 1 / (r.types + 1) for r in sizes}
        per = spark.createDataFrame([(x, d[x], base[x]) for x in langs], "lang string, d double, base double")
        contexts = c.stage(levels[order].groupBy("lang", "a").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
                           .join(F.broadcast(per), "lang").withColumn("weight", F.col("d") * F.col("kinds") / F.col("total")), "contexts")
        grams = levels[order].join(contexts, ["lang", "a"])
        if order == 1:
            floor = {r.lang: r.weight * r.base for r in contexts.collect()}
        else:
            lower = out[-1][0].select("lang", F.col("a").alias("_a"), "b", F.col("p").alias("base"))
            grams = grams.drop("base").withColumn("_a", _masked("a", order - 1)).join(lower, ["lang", "_a", "b"])
        grams = c.stage(grams.select("lang", "a", "b", ((F.col("n") - F.col("d")) / F.col("total") + F.col("weight") * F.col("base")).alias("p")),
                        "grams")
        out.append((grams, contexts.select("lang", "a", "weight")))
    log = F.log("n")
    letters = types.groupBy("lang", "b").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * log).alias("one"), F.sum(F.col("n") * log * log).alias("two")).collect()
    mean = {r.lang: float(np.log(r.n) - r.one / r.n) for r in letters}
    square = {r.lang: float(r.two / r.n - 2 * np.log(r.n) * r.one / r.n + np.log(r.n) ** 2) for r in letters}
    return (out, np.array([floor[x] for x in langs]),
            np.array([(mean[x], max(square[x] - mean[x] ** 2, 0.0) ** 0.5) for x in langs]).T)


def _masked(name: str, order: int) -> Column:
    return F.col(name).bitwiseAND(F.lit(MASKS[order]).cast("long"))


def _words(batches):
    """The words of each text with their numbers."""
    schema = pa.schema([("_h", pa.int64()), ("_g", pa.int32()), ("word", pa.string()), ("n", pa.int64())])
    for batch in c.groups(batches, limit=c.GROUP_BYTES // 4):
        counts = [Counter(WORD.findall(t.lower())) for t in batch.column("_text").to_pylist()]
        row = np.repeat(np.arange(len(counts)), [len(x) for x in counts])
        yield pa.RecordBatch.from_arrays(
            [batch.column("_h").take(pa.array(row)), batch.column("_g").take(pa.array(row)), pa.array([w for x in counts for w in x], pa.string()),
             pa.array([k for x in counts for k in x.values()], pa.int64())], schema=schema)


def _word_grams(batches):
    """The 4-grams of each word with their numbers."""
    for batch in c.groups(batches, "word", c.GROUP_BYTES // 4):
        words = batch.column("word").to_pylist()
        x, at, start = _stream(words)
        a, b = _pack(x, at)
        row = np.repeat(np.arange(len(words)), np.diff(np.r_[start, len(at)]))
        order = np.lexsort((b, a, row))
        a, b, row = a[order], b[order], row[order]
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        own = pa.array(row[first])
        yield pa.RecordBatch.from_arrays(
            [batch.column("w").take(own), batch.column("v").take(own), pa.array(c.signed(a[first])), pa.array(b[first].astype(np.int32)),
             pa.array(np.diff(np.r_[first, len(a)]))], names=["w", "v", "a", "b", "n"])


def _word_costs_joined(words: DataFrame, model: Model) -> DataFrame:
    """``w, v`` of every word with ``size`` (its characters and its end) and ``c0, c1, ...``, its cost in each language."""
    spark, costs = words.sparkSession, [f"c{k}" for k in range(len(model.langs))]
    grams = c.stage(words.dropDuplicates(["w", "v"]).mapInArrow(_word_grams, "w long, v int, a long, b int, n long"), "word-grams")
    floors = spark.createDataFrame(list(zip(model.langs, map(float, model.floor), strict=True)), "lang string, p double")
    cost = grams.select("a", "b").distinct().crossJoin(F.broadcast(floors))
    for order, (seen, contexts) in enumerate(model.tables, 1):
        cost = cost.withColumn("_a", _masked("a", order))
        if order > 1:
            cost = cost.join(contexts.withColumnRenamed("a", "_a"), ["lang", "_a"], "left").withColumn(
                "p", F.coalesce("weight", F.lit(1.0)) * F.col("p")).drop("weight")
        cost = cost.join(seen.select("lang", F.col("a").alias("_a"), "b", F.col("p").alias("own")), ["lang", "_a", "b"], "left").withColumn(
            "p", F.coalesce("own", "p")).drop("own", "_a")
    cost = c.stage(cost.groupBy("a", "b").agg(*[F.max(F.when(F.col("lang") == x, -F.log("p"))).alias(k)
                                               for k, x in zip(costs, model.langs, strict=True)]), "gram-costs")
    return c.stage(grams.join(cost, ["a", "b"]).groupBy("w", "v").agg(
        F.sum("n").alias("size"), *[F.sum(F.col("n") * F.col(k)).alias(k) for k in costs]), "word-costs")


def _text_key(text: Column) -> list[Column]:
    text = F.coalesce(text.cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("_h"), F.hash(text).alias("_g")]


def _text_costs(texts: DataFrame, model: Model) -> DataFrame:
    """``_h, _g`` of every distinct ``_text`` with a letter, ``_n`` and ``_total``, its cost in each language."""
    rows = texts.select(*_text_key(F.col("_text")), F.coalesce("_text", F.lit("")).alias("_text")).dropDuplicates(["_h", "_g"])
    found = c.stage(rows.mapInArrow(_words, "_h long, _g int, word string, n long").select(
        "_h", "_g", F.xxhash64("word").alias("w"), F.hash("word").alias("v"), "word", "n"), "words")
    # Staged, so that adaptive execution splits the very common words of the join.
    costs = _word_costs_joined(found.select("w", "v", "word"), model)
    return c.stage(found.drop("word").join(costs, ["w", "v"]).groupBy("_h", "_g").agg(
        F.sum(F.col("n") * F.col("size")).cast("double").alias("_n"),
        F.array(*[F.sum(F.col("n") * F.col(f"c{k}")) for k in range(len(model.langs))]).alias("_total")), "text-costs")


def _with_costs(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with ``_n`` and ``_total`` for their ``_text``."""
    known = _text_costs(rows.select("_text"), model)
    zeros = F.array(*[F.lit(0.0)] * len(model.langs))
    return rows.select(*_text_key(F.col("_text")), *[x for x in rows.columns if x != "_text"]).join(known, ["_h", "_g"], "left").withColumn(
        "_n", F.coalesce("_n", F.lit(0.0))).withColumn("_total", F.coalesce("_total", zeros))


def _logistic(x: np.ndarray, hit: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of ``hit`` on ``x``, slightly regularised, by Newton steps."""
    w = np.array([0.0, 0.1])
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (n * (hit - p)) - 0.1 * w
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(max(w[1], 0.0))


def fold_of(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 4


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", hash_bits: int = 20,
          accept: float = 0.9999, slack: float = 0.25, min_score: float = 0.05) -> Model:
    """The model, from the labelled documents outside fold 2."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).cast("string").alias("_text"), F.col(lang_col).cast("string").alias("lang"),
                       fold_of(id_col).alias("fold")).filter("_text IS NOT NULL AND lang IS NOT NULL AND fold <> 2")
    types = (rows.filter("fold < 2").select("_text", "lang").mapInArrow(_count_types, "lang string, a long, b int, n long")
             .groupBy("lang", "a", "b").agg(F.sum("n").alias("n")))
    types = c.stage(types, "types")
    sizes = {r.lang: r["count"] for r in types.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], [], [], np.empty(0))
    if sum(sizes.values()) * len(langs) > 4 << hash_bits:
        tables, floor, chance = _tables(types, langs)
        model = Model(langs, [], [], floor, chance, min_score=min_score, tables=tables)
    else:
        counts = types.toArrow().to_pandas()
        parts = [(*_estimate(own["a"].to_numpy().view(np.uint64), own["b"].to_numpy().astype(np.uint64), own["n"].to_numpy()),
                  _chance(own["b"].to_numpy(), own["n"].to_numpy()))
                 for own in (counts[counts["lang"] == lang].sort_values(["a", "b"]) for lang in langs)]
        model = Model(langs, [_together([p[0][o] for p in parts], 0.0) for o in range(ORDER)],
                      [_together([p[1][o] for p in parts], 1.0) for o in range(ORDER)], np.array([p[2] for p in parts]),
                      np.array([p[3] for p in parts]).T, min_score=min_score)

    held = rows.filter("fold = 3").select("_text", "lang")
    cells = ((held if model.tables is None else _with_costs(held, model))
             .mapInArrow(_histogram(spark.sparkContext.broadcast(replace(model, tables=None))), "right boolean, size int, ce int, margin int, n long")
             .groupBy("right", "size", "ce", "margin").agg(F.sum("n").alias("n")).toPandas())
    if len(cells):
        model.logistic = _logistic(cells["margin"].to_numpy() * MARGIN_BIN + MARGIN_BIN / 2, cells["right"].to_numpy(float),
                                   cells["n"].to_numpy(float))
    model.limits = _limits(cells, model.chance, accept, slack)
    return model


def rejects(model: Model, texts: list[str | None]):
    """By text: whether it is rejected, index of its language (one past the last: ``und``), score,
    cross-entropy."""
    return _verdict(model, *judge(model, texts))


def _verdict(model: Model, n, best, ce, margin):
    some = (n > 0) & bool(model.langs)
    score = np.where(some, model.score(margin), 0.0)
    limit = np.inf if model.limits is None else model.limits[_length_class(n), best]
    return (~some | (ce > limit) | (score < model.min_score), np.where(some, best, len(model.langs)), score,
            np.where(some, ce, 0.0))


def _predict(shared):
    def run(batches):
        names = np.array([*shared.value.langs, "und"], dtype=object)
        for batch, judged in _judged(shared.value, batches):
            gone, best, score, ce = _verdict(shared.value, *judged)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_k"), batch.column("_j"), pa.array(names[best], pa.string()), pa.array(score),
                 pa.array(ce), pa.array(gone)],
                names=["_id", "_k", "_j", "lang_pred", "score", "cross_entropy", "rejected"])

    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``_id, _k, _j, lang_pred, score, cross_entropy, rejected``."""
    rows = c.keyed(docs, id_col, text_col)
    if model.tables is not None:
        rows = _with_costs(rows, model)
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, tables=None))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(_predict(shared), f"_id {kind}, _k long, _j int, lang_pred string, score double, "
                                             "cross_entropy double, rejected boolean")


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, tables=None))
    if model.tables is not None:
        known = _text_costs(docs.select(F.col(text_col).cast("string").alias("_text")), model)

        def stays(batches):
            for batch, judged in _judged(shared.value, batches):
                yield batch.select(["_h", "_g"]).filter(pa.array(~_verdict(shared.value, *judged)[0]))

        kept = known.mapInArrow(stays, "_h long, _g int")
        h, g = _text_key(F.col(text_col))
        return docs.join(kept, (h == kept["_h"]) & (g == kept["_g"]), "left_semi")
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in c.groups([batch], batch.schema.names[at], c.GROUP_BYTES // 4):
                gone, *_ = rejects(shared.value, part.column(at).to_pylist())
                yield part.filter(pa.array(~gone))

    return docs.mapInArrow(run, docs.schema)


def op2_language(spark, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``, learned outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, train(docs)).withColumnRenamed("_id", "doc_id").select(
        "doc_id", F.coalesce(fold_of("doc_id") == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
