r"""Language by ranked character n-gram profiles (out-of-place distance).

A word is a maximal letter run of the lower-cased text, written ``_word_``; its grams are all its
substrings of one to three characters.  The profile of a language lists its ``size`` most frequent
grams in order (of equal ones, the smaller by code points); so does that of a text.  The distance
of a text from a language sums, over the text's grams, how many places each stands apart in the two
lists, ``size`` if the language's list lacks it.  The nearest language wins, of equal ones the smaller name.

Unlike stop-word lists, this needs no listed word in the text and reads any letters that rows with a
known language hold.

Cost: training counts words per language first, then their grams, both combined before the shuffle;
``size`` grams a language reach the driver.  Scoring is row-local: no shuffle, no join.

Defined results: a text that is null or has no letter is ``und`` with a null distance, as is every text
where no row has a known language; rows of null text or language teach nothing.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from heapq import nsmallest
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE, LENGTHS = 300, (1, 2, 3)


def letter_runs(text: Column) -> Column:
    """Words of the lower-cased text; null has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))


def gram_counts(labelled: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, gram, n`` over every row with a known language."""
    words = (labelled.filter(F.col(lang_col).isNotNull())
             .select(F.col(lang_col).alias("lang"), F.explode(letter_runs(F.col(text_col))).alias("word"))
             .groupBy("lang", "word").agg(F.count("*").alias("n")))
    padded = F.concat(F.lit("_"), "word", F.lit("_"))

    # A word of one letter has grams of up to three characters.
    def of_length(k: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length("word") + 3 - k), lambda i: F.substring(padded, i, F.lit(k)))

    grams = F.concat(*map(of_length, LENGTHS))
    return words.select("lang", "n", F.explode(grams).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def language_profiles(labelled: DataFrame, text_col: str, lang_col: str, size: int = SIZE) -> dict[str, list[str]]:
    """The ranked grams of every language (``size`` a language at most).  Writes a checkpoint of the counts."""
    counts = gram_counts(labelled, text_col, lang_col).checkpoint()
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if not langs:
        return {}
    tops = [counts.filter(F.col("lang") == lang).orderBy(F.desc("n"), "gram").limit(size) for lang in langs]
    out: dict[str, list[str]] = {lang: [] for lang in langs}
    for r in sorted(reduce(DataFrame.unionByName, tops).collect(), key=lambda r: (-r.n, r.gram)):
        out[r.lang].append(r.gram)
    return out


def text_profile(words, size: int = SIZE) -> list[str]:
    """The ranked grams of a text; words stand apart by a space, and grams that cross it do not count."""
    line = " ".join([f"_{w}_" for w in words])
    grams = Counter(line)
    grams.update(map(add, line, line[1:]))
    grams.update(map(add, map(add, line, line[1:]), line[2:]))
    own = [(-n, g) for g, n in grams.items() if " " not in g]
    return [g for _, g in nsmallest(size, own)]


def nearest_language(text: Column, profiles: dict[str, list[str]], size: int = SIZE) -> Column:
    """Struct of ``lang`` and ``distance``."""
    ranks = [(lang, {g: i for i, g in enumerate(grams)}) for lang, grams in sorted(profiles.items())]

    def score(words: pd.Series) -> pd.DataFrame:
        langs, distances = [], []
        for row in words:
            own = text_profile(row, size)
            best = min(((sum(abs(i - rank[g]) if g in rank else size for i, g in enumerate(own)), lang)
                        for lang, rank in ranks), default=None) if own else None
            langs.append(best[1] if best else "und")
            distances.append(best[0] if best else None)
        return pd.DataFrame({"lang": langs, "distance": pd.array(distances, dtype="Int64")})

    return F.pandas_udf(score, "lang string, distance long")(letter_runs(text))


def detect_by_profile(rows: DataFrame, profiles: dict[str, list[str]], text_col: str, size: int = SIZE) -> DataFrame:
    """``rows`` with ``lang_pred`` and ``lang_distance``."""
    found = nearest_language(F.col(text_col), profiles, size)
    return (rows.withColumn("_found", found)
            .select(*[F.col(f"`{x}`") for x in rows.columns], F.col("_found.lang").alias("lang_pred"),
                    F.col("_found.distance").alias("lang_distance")))
