"""URL filters: rules first, then segmented host words and a naive Bayes verdict.

1. A url gives host and path; the longest rule that fits decides.
2. Host names are words run together.  Word counts over the text of all pages are the
   unigram model; a name's substrings (of distinct names only) meet those counts in a join,
   and the Viterbi path over them is the name's most likely split.  A part that is no known
   word costs ``1 / (total * UNKNOWN ** length)``, so unknown names stay whole.  Names and words
   may be of any length: a word of more than ``STEM`` letters is joined by its first ``STEM``.
3. Pages that a rule decides are the labelled examples of a multinomial naive Bayes model
   over the host's words and the path's tokens.  Its weights are a table with a row for every token
   seen, joined by token; distinct hosts and distinct paths are scored, and pages take both sums.
   Pages without a rule get its verdict (``block`` where the log odds are above zero, else ``allow``).

Cost: the pages' text is read once and leaves its tasks as partial word counts; hosts are
split once per distinct name; tokens are counted per distinct host and path, not per page,
and travel with a 128-bit digest of it, as a path may be long; no group is gathered but the words of one name.  The joins of pages with their host's and path's
scores split hot keys explicitly.

Defined results: a null url or one without ``://`` has an empty host and path (no words, the
prior decides); null html has no words; equal rows get equal results; without labelled
pages nothing is blocked by the method; an empty table gives no rows.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewops.llm import common as c
from reviewops.operators.hotkeys import hot_keys, join_splitting_hot_keys

# (verdict, host, path): a rule fits its host and all subdomains where the path starts so.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
STEM, UNKNOWN = 24, 10.0


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits (as host and path in one string) and its verdict, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        text, verdict = F.when(fits, name + start).otherwise(text), F.when(fits, what).otherwise(verdict)
    return text, verdict


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``word, n`` over the visible text of every page."""
    shown = F.regexp_replace(F.col(html_col), r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|&#?\w+;", " ")
    words = F.regexp_extract_all(F.lower(shown), F.lit(r"\p{L}+"), F.lit(0))
    return pages.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def split_name(name: str, known: dict[str, int], total: int) -> list[str]:
    """Most likely split of ``name``; of equal ones, the one whose last part is longest.

    A part that is no word costs the same for every letter, so the best start of one is carried along;
    only the lengths of known words are tried at every end."""
    lengths = sorted({len(w) for w in known}, reverse=True)
    letter, new = math.log(UNKNOWN), -math.log(total)
    best, back = [0.0], [0]
    start, gain = 0, 0.0  # where a part that is no word starts best, and its worth before its letters
    for end in range(1, len(name) + 1):
        found, at = gain + new - end * letter, start
        for n in lengths:
            if n <= end and (seen := known.get(name[end - n:end], 0)):
                p = best[end - n] + math.log(seen / total)
                if p > found or (p == found and end - n < at):
                    found, at = p, end - n
        best.append(found)
        back.append(at)
        if found + end * letter > gain:
            start, gain = end, found + end * letter
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def _split(total: int):
    def run(batches):
        for batch in batches:
            names = batch.column("name").to_pylist()
            words = [split_name(name, {x["word"]: x["n"] for x in known or []}, total)
                     for name, known in zip(names, batch.column("known").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(words, pa.list_(pa.string()))], names=["name", "words"])

    return run


def segmented(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``host, words``: the words of every (distinct) host, in order."""
    counts = c.stage(counts.withColumn("stem", F.substring("word", 1, STEM)), "words")
    total = max(counts.agg(F.sum("n")).first()[0] or 0, 1)
    names = hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit(r"\p{L}+"), F.lit(0))).alias("at", "name"))
    names = c.stage(names, "names")
    distinct = names.select("name").distinct()
    size = F.length("name")
    cuts = F.flatten(F.transform(F.sequence(F.lit(1), size), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(size - i + 1, F.lit(STEM))), lambda n: F.substring(F.col("name"), i, n))))
    # A cut shorter than STEM is a whole word; one of STEM letters starts longer words as well.
    known = (distinct.select("name", F.explode(F.array_distinct(cuts)).alias("stem")).join(counts, "stem")
             .filter((F.length("word") <= STEM) | (F.instr("name", F.col("word")) > 0))
             .groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("known")))
    words = distinct.join(known, "name", "left").mapInArrow(_split(total), "name string, words array<string>")
    # A host has few names (its length bounds them).
    return names.join(words, "name").groupBy("host").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("words"))


def token_weights(tokens: DataFrame) -> DataFrame:
    """``token, weight`` (log odds of block, add-one smoothed) from ``token, bad, n``: how often each stands in
    labelled pages.  A token that no labelled page has gets no row and says nothing."""
    seen = c.stage(tokens.groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).filter("n > 0"), "tokens")
    size, bad, all_ = seen.agg(F.count("*"), F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    size = max(size, 1)
    return seen.select("token", (F.log((F.col("bad") + 1) / F.lit(float(bad + size)))
                                 - F.log((F.col("n") - F.col("bad") + 1) / F.lit(float(all_ - bad + size)))).alias("weight"))


def _digest(text: str) -> Column:
    return F.unhex(F.md5(text))


def _take(urls: DataFrame, scores: DataFrame, key: str, rows: DataFrame) -> DataFrame:
    """``urls`` with its ``key``'s row of ``scores``; ``rows`` counts the urls of each key."""
    total = rows.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return join_splitting_hot_keys(urls, scores, key, "inner", hot_keys(rows, key, "rows", F.lit(total)))


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule``, ``verdict``, ``words`` (of the host) and
    ``log_odds`` (above zero: block)."""
    host, path = parts(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = urls.select("_id", "host", "path", text.alias("rule"), verdict.alias("ruled"))
    urls = c.stage(urls, "urls")
    bad = F.when(F.col("ruled") == "block", 1).otherwise(0).cast("long")
    counted = [F.count("*").alias("rows"), F.count("ruled").alias("n"), F.sum(bad).alias("bad")]
    by_host = c.stage(urls.groupBy("host").agg(*counted), "hosts")
    by_path = c.stage(urls.groupBy("path").agg(*counted), "paths")
    n_bad, n_all = by_host.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    prior = math.log((n_bad + 1) / (n_all - n_bad + 1))

    words = segmented(by_host.select("host"), word_counts(pages, html_col))
    hosts = c.stage(by_host.join(words, "host", "left").withColumn("tokens", F.transform(
        F.coalesce("words", F.array().cast("array<string>")), lambda w: F.concat(F.lit("h:"), w))), "host-words")
    paths = by_path.withColumn("tokens", F.transform(F.regexp_extract_all(F.lower("path"), F.lit(r"\p{L}+|[0-9]+"), F.lit(0)),
                                                     lambda w: F.concat(F.lit("p:"), F.regexp_replace(w, "[0-9]", "0"))))
    said = [c.stage(df.select(_digest(key).alias("key"), "bad", "n", "tokens").select("key", "bad", "n", F.explode("tokens").alias("token")),
                    f"{key}-tokens") for df, key in ((hosts, "host"), (paths, "path"))]
    weights = c.stage(token_weights(said[0].select("token", "bad", "n").unionByName(said[1].select("token", "bad", "n"))), "weights")
    odds = [df.join(weights, "token").groupBy("key").agg(F.sum("weight").alias("odds")) for df in said]
    host_scores = c.stage(hosts.select("host", "words", _digest("host").alias("key")).join(odds[0], "key", "left")
                          .select("host", "words", F.col("odds").alias("host_odds")), "host-odds")
    path_scores = c.stage(paths.select("path", _digest("path").alias("key")).join(odds[1], "key", "left")
                          .select("path", F.col("odds").alias("path_odds")), "path-odds")

    out = _take(_take(urls, host_scores, "host", by_host), path_scores, "path", by_path)
    log_odds = F.lit(prior) + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0))
    by_model = F.when(log_odds > 1e-9, "block").otherwise("allow")
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "words",
                      log_odds.alias("log_odds"))


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every url of ``pages``."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet")).select(
        "page_id", "host", "path", "rule", "verdict", F.array_join("words", " ").alias("host_words"))
