"""Personal data by bootstrapped contextual extraction.

1. Seeds: e-mail addresses, IP addresses, card numbers (Luhn) and phone numbers, found by the
   base expressions (leftmost, non-overlapping per kind; a match that fails its test is
   dropped, not retried).
2. Every mention (a seed, or another token of any length with a digit or ``@``) induces
   two lexical patterns: the two words before it, and the word before with the word after
   (fewer at a text's ends).
3. Distinct (pattern, instance) pairs are a graph that Spark scores in rounds, up to the fixpoint: a pattern's
   confidence is the sum of its instances' scores over their number plus one; an instance
   that is no seed scores ``1 - product(1 - confidence)`` over its trusted patterns.  A pattern is
   trusted with a support (the sum of its instances' scores, a seed being one) of at least
   ``min_support`` and a confidence of ``min_confidence``; so what one round discovers can make
   a pattern trusted that no seed ever stood in.
4. Other tokens that stand in a trusted pattern are personal data of kind ``context``.

Cost: one pass over the text without a shuffle; after that only mentions are moved, as
distinct pairs combined before the shuffle.  A pattern or an instance of very many rows is
a key of partial aggregates and of joins that adaptive execution splits.

Defined results: null text is empty; equal rows get equal results; spans are code points,
end exclusive; context spans never overlap base spans; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewops.llm import common as c
from reviewops.llm.op5_secrets import count_of, joined

KINDS = ["email", "ip", "card", "phone"]
# The base expressions.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = re.compile(r"[0-9]+")
MARK = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
# Characters around a mention that are read at first for its words; the longest token that stands in
# the graph as it is; what is stripped from tokens and words.
CONTEXT, MOST = 200, 64
# Sums of scores are compared with this slack, as their order is not fixed; the rounds end when the
# confidences of the trusted patterns together grow by no more.
STILL = 1e-6
EDGES = ".,;:!?()[]{}<>\"'`#$%&*|=~^+-/\\_"


def _luhn(digits: str) -> bool:
    total = 0
    for k, x in enumerate(reversed(digits)):
        n = int(x) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str):
    """An address starts where the run of local characters before an ``@`` starts; any later
    start in the run matches or fails with it."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            yield start, m.end()
            after = m.end()
        at = text.find("@", max(at + 1, after))


def ips(text: str):
    """Whether an address starts in a run of digits depends on the run's end alone."""
    after = 0
    for run in DIGITS.finditer(text):
        if run.end() > after and (m := IP.match(text, max(run.start(), after))):
            after = m.end()
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
                yield m.start(), after


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of every base span, in order."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if DIGITS.search(text):
        out += [(s, 1, e) for s, e in ips(text)]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 10 <= sum(x.isdigit() for x in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def tokens(text: str):
    """Other mentions: tokens between white space with a digit or ``@``, stripped."""
    at = 0
    while m := MARK.search(text, at):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = SPACE.search(text, m.end())
        at = end.start() if end else len(text)
        word = text[start:at]
        left = len(word) - len(word.lstrip(EDGES))
        word = word.strip(EDGES)
        if MARK.search(word) and any(map(str.isalnum, word)):
            yield start + left, start + left + len(word)


def _word(word: str) -> str:
    return DIGITS.sub("0", word.lower().strip(EDGES))


def patterns(text: str, start: int, end: int) -> list[str]:
    before, after, reach = [], [], CONTEXT
    while len(before) < 2:
        at = max(0, start - reach)
        cut = at > 0 and not text[at - 1].isspace() and not text[at].isspace()
        before = [w for x in text[at:start].split()[cut:] if (w := _word(x))]
        if not at:
            break
        reach *= 4
    reach = CONTEXT
    while not after:
        to = end + reach
        cut = to < len(text) and not text[to - 1].isspace() and not text[to].isspace()
        parts = text[end:to].split()
        after = [w for x in parts[:len(parts) - cut] if (w := _word(x))]
        if to >= len(text):
            break
        reach *= 4
    a, b = (["^", "^"] + before)[-2:]
    z = (after or ["$"])[0]
    # A pattern needs a word: the mere start or end of a text says nothing.
    return [f"{a} {b} _"] * (b != "^") + [f"{b} _ {z}"] * ((b, z) != ("^", "$"))


def _instance(word: str) -> str:
    return word if len(word) <= MOST else hashlib.sha256(word.encode()).hexdigest() + " "


def _scan(batches):
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    mention = pa.list_(pa.struct([("instance", pa.string()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.string())),
                                  ("start", pa.int32()), ("end", pa.int32())]))
    number = TaskContext.get().partitionId() << 33
    for batch in c.groups(batches):
        base, mentions = [], []
        for text in batch.column("_text").to_pylist():
            text = text or ""
            own = base_spans(text)
            base.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in own])
            said, k, reach = [(s, e, True) for s, _, e in own], 0, 0
            for s, e in tokens(text):
                while k < len(own) and own[k][0] < e:
                    reach = max(reach, own[k][2])
                    k += 1
                if reach <= s:
                    said.append((s, e, False))
            mentions.append([{"instance": _instance(text[s:e].lower()), "seed": seed, "patterns": patterns(text, s, e), "start": s, "end": e}
                             for s, e, seed in said])
        rows = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(number, number + rows), pa.int64()), batch.column("_id"), pa.array(base, spans), pa.array(mentions, mention)],
            names=["row", "_id", "base", "mentions"])
        number += rows


def trusted_patterns(edges: DataFrame, min_support: int, min_confidence: float, rounds: int | None = None) -> DataFrame:
    """``pattern, confidence`` of the trusted patterns of ``edges`` (pattern, instance, seed), at the fixpoint
    (scores only grow) or after ``rounds``.  The support of a pattern is the sum of its instances' scores."""
    known = edges.filter("seed").select("instance").distinct().withColumn("score", F.lit(1.0))
    last = None
    for turn in itertools.count(1):
        scored = edges.join(known, "instance", "left")
        trusted = c.stage(scored.groupBy("pattern").agg(
            F.sum(F.coalesce("score", F.lit(0.0))).alias("support"), F.count("*").alias("n"))
            .withColumn("confidence", F.col("support") / (F.col("n") + 1))
            .filter((F.col("support") >= min_support - STILL) & (F.col("confidence") >= min_confidence - STILL))
            .select("pattern", "confidence"), "patterns")
        now = trusted.agg(F.count("*").alias("n"), F.coalesce(F.sum("confidence"), F.lit(0.0)).alias("sum")).first()
        if turn == rounds or not now.n or (last and last.n == now.n and now.sum - last.sum <= STILL):
            return trusted
        last = now
        miss = F.sum(F.log(1 - F.least("confidence", F.lit(0.999))))
        known = c.stage(edges.filter("NOT seed").join(trusted, "pattern").groupBy("instance").agg((1 - F.exp(miss)).alias("score"))
                        .unionByName(edges.filter("seed").select("instance").distinct().withColumn("score", F.lit(1.0)))
                        .groupBy("instance").agg(F.max("score").alias("score")), "instances")


def find_personal_data(docs: DataFrame, min_support: int = 3, min_confidence: float = 0.5, rounds: int | None = None,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``base`` and ``added``, arrays of (kind, start, end) by start,
    then kind."""
    rows = c.keyed(docs, id_col, text_col).select("_id", "_text")
    span = "array<struct<kind:string,start:int,end:int>>"
    scanned = c.stage(rows.mapInArrow(_scan, f"row long, _id {rows.schema['_id'].dataType.simpleString()}, base {span}, mentions "
                                             "array<struct<instance:string,seed:boolean,patterns:array<string>,start:int,end:int>>"), "mentions")
    said = scanned.select("row", F.explode("mentions").alias("m")).select("row", "m.*").withColumn("pattern", F.explode("patterns"))
    edges = c.stage(said.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pairs")
    trusted = trusted_patterns(edges, min_support, min_confidence, rounds)
    added = (said.filter("NOT seed").join(trusted.select("pattern"), "pattern", "left_semi")
             .groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("at")))
    new = F.transform(F.sort_array(F.coalesce("at", F.array().cast("array<struct<start:int,end:int>>"))),
                      lambda s: F.struct(F.lit("context").alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return scanned.select("row", "_id", "base").join(added, "row", "left").select(
        F.col("_id").alias(id_col), "base", new.alias("added"))


def op7_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of ``documents``."""
    base, added = F.col("base"), F.col("added")
    everything = F.array_sort(F.concat(base, added), lambda a, b: F.when(a["start"] < b["start"], -1).when(
        a["start"] > b["start"], 1).when(_rank(a["kind"]) < _rank(b["kind"]), -1).when(_rank(a["kind"]) > _rank(b["kind"]), 1).otherwise(0))
    return find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", *[count_of(base, k).alias(f"n_{k}") for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
        joined(everything).alias("spans"), F.size(added).cast("long").alias("n_context"))


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in [*KINDS, "context"]]), kind)
