import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from reviewops.llm.op1_substring import op1_substring_dedup, substring_dedup

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, n):
    """Per row (n_words, n_removed, kept text), by listing every window."""
    words = [WORD.findall(text or "") for _, text in rows]
    seen = Counter(tuple(w[i:i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i:i + n])] > 1:
                gone.update(range(i, i + n))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc_id, len(w), len(gone), kept))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=str)


def corpus(seed, size, words=40):
    r = random.Random(seed)
    say = lambda k: [f"w{r.randrange(words)}" for _ in range(k)]
    shared = [say(r.randrange(5, 60)) for _ in range(6)]
    rows = []
    for i in range(size):
        w = say(r.randrange(0, 30))
        for _ in range(r.randrange(0, 3)):
            w += r.choice(shared) + say(r.randrange(0, 10))
        if w and r.random() < 0.3:
            w[r.randrange(len(w))] = "odd"
        rows.append((i, r.choice([" ", "\n", " \t"]).join(w)))
    return rows


def test_against_brute_force(make_docs):
    for seed, n, words in ((1, 35, 400), (2, 12, 40), (3, 5, 6), (4, 7, 2)):
        rows = corpus(seed, 60, words)
        assert got(substring_dedup(make_docs(rows), n)) == brute(rows, n)


def test_edges(make_docs):
    same = " ".join(f"a{i}" for i in range(50))
    loop = "x " * 90
    rows = [(1, None), (2, ""), (None, same), (4, same), (5, loop), (6, "é b " + same), (6, "é b " + same),
            (8, " ".join(f"b{i}" for i in range(34))), (9, " ".join(f"b{i}" for i in range(34))), (None, None)]
    assert got(substring_dedup(make_docs(rows))) == brute(rows, 35)


def test_empty_table_and_odd_columns(spark, make_docs):
    assert substring_dedup(make_docs([])).collect() == []
    docs = make_docs([(1, "x " * 50), (2, "y")]).withColumn("_k", F.lit("k")).withColumn("n_words", F.lit(3))
    assert [r[1] for r in got(substring_dedup(docs))] == [50, 1]


def test_very_long_text(make_docs):
    text = " ".join(f"v{i % 70001}" for i in range(400_000))
    rows = [(1, text), (2, text[1000:2000])]
    assert [r[:3] for r in got(substring_dedup(make_docs(rows)))] == [r[:3] for r in brute(rows, 35)]


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = brute([(r.doc_id, r.text) for r in docs], 35)
    have = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in op1_substring_dedup(spark, sf).collect()),
                  key=str)
    assert have == sorted(((a, b, d, hashlib.sha256(k.encode()).hexdigest()) for a, b, d, k in want), key=str)
    assert sum(r[2] for r in have) > 0
