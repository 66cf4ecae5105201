import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from reviewops.llm import op11_phrases as op


def brute(rows, least=30, share=80, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) from rows of (text, lang)."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            total[lang or "und"] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    counts[lang or "und"][tuple(w[i:i + m])] += 1
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = defaultdict(int)
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i:i + m]] = max(longer[p[i:i + m]], a)
        rows = []
        for p, a in cand.items():
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if 100 * longer[p] < share * a:
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, total[lang], -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def prose(r, n, words=40):
    vocab = ["the", "Of", "a\x1fb", "Ünï", "ünï", "x\x00y", "　"] + [f"w{i}" for i in range(words)]
    return "".join(r.choice(vocab[:1 + int(r.random() ** 2 * len(vocab))]) + r.choice([" ", " ", " ", " ", "\t ", ". ", "\n", ",", " ", "\r\n"]) for _ in range(n))


def test_equals_brute_force(make_docs):
    r = random.Random(2)
    rows = [(prose(r, r.randrange(0, 60)), r.choice(["en", "en", "de", None, "und"])) for _ in range(1200)]
    rows += [("alpha beta gamma delta epsilon", "fr")] * 35 + [("alpha beta", "fr")] * 5 + [(None, "en"), ("", None)]
    docs = make_docs([(i, t, lang) for i, (t, lang) in enumerate(rows)])
    want = brute(rows)
    assert len(want) > 10 and any(x[0] == "fr" and x[2] == "alpha beta gamma delta" for x in want)
    assert got(op.mine_phrases(docs)) == want
    assert got(op.mine_phrases(docs, least=3, share=50, top=40)) == brute(rows, 3, 50, 40)


def test_long_text_over_many_shards_and_buckets(make_docs, monkeypatch):
    """Shards, text pieces and buckets far smaller than the data give the same counts."""
    monkeypatch.setattr(op, "SHARD_WORDS", 50)
    monkeypatch.setattr(op, "GROUP_KEYS", 64)
    monkeypatch.setattr(op, "PIECE", 90)
    r = random.Random(3)
    rows = [(prose(r, 6000, 20).replace(". ", " "), "en"), ("go on " * 700, "en"), (prose(r, 300, 10), None)]
    docs = make_docs([(i, t, lang) for i, (t, lang) in enumerate(rows)]).coalesce(1)
    shards = docs.selectExpr("coalesce(lang, 'und') as _lang", "text as _text").mapInArrow(
        op._shards(50, 90), "shard long, head int, codes binary, keys array<binary>, counts array<long>")
    assert shards.count() > 20 and shards.filter("head = 3").count() > 10
    assert got(op.mine_phrases(docs, least=5)) == brute(rows, 5)


def test_ties_at_the_last_rank(make_docs):
    rows = [(f"p{i % 7} q{i % 7}", "en") for i in range(70)]
    docs = make_docs([(i, *x) for i, x in enumerate(rows)])
    assert got(op.mine_phrases(docs, least=10, top=3)) == brute(rows, 10, 80, 3)
    assert [x[2] for x in got(op.mine_phrases(docs, least=10, top=3))] == ["p0 q0", "p1 q1", "p2 q2"]


def test_products_past_64_bits(spark):
    """Scores of counts that no table here can reach."""
    a = 8 * 10**18
    phrases = spark.createDataFrame([(1, 2, 0, 0, a)], "p1 long, p2 long, p3 long, p4 long, a long")
    vocabulary = spark.createDataFrame([("en", 1, a + 5, "x"), ("en", 2, 9 * 10**18, "y")], "lang string, id long, f long, word string")
    row = op._scored(phrases, vocabulary).first()
    assert (row.score, row.l, row.r, row.lang) == (2000000 * a // (a + 5 + 9 * 10**18), a + 5, 9 * 10**18, "en")
    longer = phrases.union(spark.createDataFrame([(1, 2, 3, 0, a // 5 * 4)], phrases.schema))
    assert op._absorbed(longer, 80).count() == 1 and op._absorbed(longer, 81).count() == 0


def test_empty_rare_and_clashing_columns(spark, make_docs):
    assert got(op.mine_phrases(make_docs([]))) == []
    assert got(op.mine_phrases(make_docs([(1, None, None), (2, "...", "en"), (3, "a b c", "en")]))) == []
    docs = make_docs([(i, "a b", "en") for i in range(30)])
    wild = docs.selectExpr("text", "lang", "1 as _text", "2 as _lang", "3 as shard", "4 as word", "5 as p1")
    assert got(op.mine_phrases(wild)) == [("en", 1, "a b", 30, 30, 30, 60, 1000000)]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    want = sorted(con.execute(f"select lang, rank, phrase, a, l, r, n, score from ({op.OP11_SQL})").fetchall())
    out = op.op11_phrases(spark, folder)
    assert got(out) == want and len(want) > 20
    assert out.filter(F.col("rank") > 2000).count() == 0
